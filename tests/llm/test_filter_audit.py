"""Operator 11 against counting document by document; its SQL is in test_oracle_sql.py."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from ledgerline.llm import filter_audit

LABELS = "doc_id bigint, quality int, toxic int"


def by_hand(docs, labels):
    """docs: (id, text, lang); labels: (id, quality, toxic)."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    parts = defaultdict(list)
    for i, text, lang in docs:
        x = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", x)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", x)) > 10 * len(x),
            "D": any(c in "#$%&*|" for c in x),
            "E": i is not None and any(j is not None and j < i and (y or "") == x for j, y, _ in docs),
        }
        parts[lang or ""].append(({k for k, f in fails.items() if f}, i in good, i in toxic))
    out, shares = [], Counter()
    for part, rows in parts.items():
        for order in permutations("ABCDE"):
            left = rows
            for step, k in enumerate(order, 1):
                gone = [r for r in left if k in r[0]]
                left = [r for r in left if k not in r[0]]
                fails = sum(k in r[0] for r in rows)
                out.append((part, "".join(order), step, len(left), len(gone), fails - len(gone), sum(r[0] == {k} for r in rows),
                            sum(r[1] for r in gone), sum(r[2] for r in gone)))
                shares[part, k] += len(gone)
    return Counter((*r, shares[r[0], r[1][r[2] - 1]]) for r in out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def found(docs, labels):
    df = filter_audit.filter_audit(docs, labels)
    assert df.columns == COLUMNS
    return Counter(map(tuple, df.collect()))


def test_messy_rows(spark, messy):
    """Nulls, empty and long texts, repeated rows and ids, several labels of one document, labels without a document."""
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 1), (4, 1, None), (5, None, 1), (None, 1, 1), (6, 1, 1), (900, 1, 1)], LABELS)
    docs = messy.drop("kept").withColumnRenamed("part", "bits").withColumnRenamed("salt", "hash").withColumnRenamed("n_tokens", "step")
    want = by_hand([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    assert found(docs, labels) == want


def test_each_filter_alone_and_its_edge(spark):
    """On the edge a document passes; one step beyond it fails."""
    plain = [f"w{i}" for i in range(100)]
    texts = {
        "passes": " ".join(plain), "A": " ".join(plain[:99]),
        "B edge": " ".join(plain[:80] + plain[:20]), "B": " ".join(plain[:79] + plain[:21]),
        "C edge": " ".join(["Ab" + "c" * 7] + [f"{c}{d}bcdefAx" for c in "klmnopqrst" for d in "klmnopqrst"]),
        "D": " ".join(plain) + "|", "copy": " ".join(plain),
    }
    rows = [(i, t, "en") for i, t in enumerate(texts.values())]
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), spark.createDataFrame([], LABELS))
    assert got == by_hand(rows, [])
    alone = {k[1][k[2] - 1]: k[6] for k in got}
    assert alone["A"] == alone["B"] == alone["D"] == alone["E"] == 1


def test_copies_count_table_wide_and_only_after_a_smaller_id(spark):
    rows = [(3, "x", "en"), (3, "x", "en"), (7, "x", "de"), (None, "x", None), (1, None, "en"), (2, "", "de"), (9, "x ", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    assert found(docs, spark.createDataFrame([], LABELS)) == by_hand(rows, [])
    marked = filter_audit.combinations(docs, spark.createDataFrame([], LABELS)).where("bits >= 16").groupBy().sum("n").first()[0]
    assert marked == 2


def test_shapley_values_add_up_to_all_removals(sample, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = filter_audit.filter_audit(sample, labels).toPandas()
    whole = got[got.step == 5].groupby("part").first()
    for part, rows in got.groupby("part"):
        each = rows.groupby(rows.apply(lambda r: r.filter_order[r.step - 1], axis=1)).shapley.first()
        n = rows[rows.step == 1].iloc[0]
        assert each.sum() == 120 * (n.kept + n.removed - whole.loc[part].kept)


def test_nothing(spark, nothing):
    assert found(nothing, spark.createDataFrame([], LABELS)) == Counter()


@pytest.mark.parametrize("parts", [1, 5])
def test_one_text_on_a_third_of_the_rows(spark, parts):
    """The copies of a hot text are one row of the join's right side, whatever their number."""
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}", "en") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(parts)
    counts = filter_audit.combinations(docs, spark.createDataFrame([], LABELS))
    assert {(r["bits"], r["n"]) for r in counts.collect()} == {(1, 2_001), (17, 999)}
