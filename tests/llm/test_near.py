"""Operators 8 and 10 and the components against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import embeddings, jaccard
from ledgerline.llm.components import components
from ledgerline.llm.shared import Scratch


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(0)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)]
    links += [(int(a), int(b)) for a, b in rng.integers(200, 400, (120, 2)) if a != b]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(df, Scratch(spark, "t"), "c").collect()}
    want = plain_components({x for p in links for x in p}, links)
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(df.limit(0), Scratch(spark, "t"), "c").collect() == []


def plain_vectors(rows, least=0.95):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v):
            x = np.array(v, float) / np.abs(v).max()
            good[i] = x / np.linalg.norm(x)
    ids = list(good)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(good[a]) == len(good[b]) and good[a] @ good[b] >= least]
    number = Counter(x for p in links for x in p)
    return links, number, plain_components([i for i, _ in rows], links)


@pytest.mark.parametrize("block", [2048, 16])
def test_clustered_vectors(spark, block):
    rng = np.random.default_rng(4)
    rows, i = [], 0
    for size in (1, 1, 1, 2, 3, 5, 60, 150):
        centre = rng.normal(size=64)
        for _ in range(size):
            rows.append((i, (centre + rng.normal(size=64) * 0.08).astype(np.float32).tolist()))
            i += 1
    rows += [(i + k, rows[0][1]) for k in range(4)] + [(i + 4, [2 * c for c in rows[0][1]])]
    rows += [(900, None), (901, [0.0] * 64), (902, [float("nan")] * 64), (903, [None] * 64), (904, []), (905, [1.0, 2.0]), (906, [2.0, 4.0])]
    rows += [(None, rows[0][1]), rows[3], rows[3]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as id", "'x' as vector", "2 as n")
    got = embeddings.near_vectors(df, block=block).collect()
    distinct = list({(k, None if v is None else tuple(map(str, v))): (k, v) for k, v in rows}.values())
    links, number, root = plain_vectors(distinct)
    assert len(got) == len(distinct)
    found = sum(r["n_links"] for r in got)
    assert 0.97 * 2 * len(links) <= found <= 2 * len(links)
    for r in got:
        assert r["n_links"] <= number[r["vec_id"]]
        assert r["component_id"] == (root[r["vec_id"]] if r["vec_id"] is not None else None)
        assert r["kept"] == (r["component_id"] == r["vec_id"])


def test_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    links, number, root = plain_vectors(rows)
    got = embeddings.near_vectors(df).collect()
    assert sum(r["n_links"] for r in got) >= 0.95 * 2 * len(links)
    assert all(r["n_links"] <= number[r["vec_id"]] for r in got)
    assert sum(r["component_id"] == root[r["vec_id"]] for r in got) >= 0.99 * len(rows)


def test_recall_at_the_threshold():
    """Pairs of cosine 0.95 to 0.97 among vectors that the rotations have not seen."""
    rng = np.random.default_rng(8)
    code = embeddings.learn_codes(embeddings.unit(rng.normal(size=(4000, 64))))
    a = embeddings.unit(rng.normal(size=(3000, 64)))
    side = embeddings.unit(rng.normal(size=(3000, 64)))
    side = embeddings.unit(side - (side * a).sum(1, keepdims=True) * a)
    cosine = rng.uniform(0.95, 0.97, (3000, 1))
    b = cosine * a + np.sqrt(1 - cosine**2) * side
    met = (embeddings.strings(a, code) == embeddings.strings(b, code)).any(axis=1)
    assert met.mean() > 0.93


@pytest.mark.parametrize("shared", [0.0, 1.0, 1.8])
def test_recall_with_a_common_direction(shared):
    """Pairs of cosine 0.95 to 0.97 among vectors whose mean has norm 0, 0.7 or 0.87."""
    rng = np.random.default_rng(9)
    make = lambda n: embeddings.unit(rng.normal(size=(n, 64)) / 8 + shared * np.eye(64)[0])
    code = embeddings.learn_codes(make(4000))
    a = make(3000)
    side = rng.normal(size=(3000, 64))
    side = embeddings.unit(side - (side * a).sum(1, keepdims=True) * a)
    cosine = rng.uniform(0.95, 0.97, (3000, 1))
    b = cosine * a + np.sqrt(1 - cosine**2) * side
    assert (embeddings.strings(a, code) == embeddings.strings(b, code)).any(axis=1).mean() > 0.93


def test_no_task_holds_a_large_bucket(spark, monkeypatch):
    """400 distinct near copies, a third of all, in blocks of 16: no group is larger than two blocks, and no link is lost
    or counted twice."""
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=32) + rng.normal(size=(400, 32)) * 0.001, rng.normal(size=(800, 32))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    seen, plain = [], embeddings._buckets
    monkeypatch.setattr(embeddings, "_buckets", lambda dealt, *rest: seen.append(dealt) or plain(dealt, *rest))
    for r in embeddings.near_vectors(df, block=16).collect():
        assert (r["n_links"], r["component_id"]) == ((399, 0) if r["vec_id"] < 400 else (0, r["vec_id"]))
    largest = seen[0].groupBy("tab", "bucket", "part").count().agg({"count": "max"}).first()[0]
    assert largest <= 80  # 26 blocks of 16 by hash; two of them, with room for chance


def test_groups_over_many_batches():
    key = np.repeat([3, 4, 5, 9], [1, 700, 2, 30])
    batches = [pa.RecordBatch.from_arrays([pa.array(key[a : a + 7])], names=["k"]) for a in range(0, len(key), 7)]
    found = []
    for table, edges in embeddings.groups(iter(batches), ("k",), most=20):
        found += [table.column(0).slice(a, b - a).to_pylist() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    assert [(x[0], len(x)) for x in found] == [(3, 1), (4, 700), (5, 2), (9, 30)]


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embeddings.near_vectors(df).collect() == []


WORD = __import__("re").compile(r"[^\x20\x09-\x0D]+")


def plain_sets(rows, width=5):
    out = []
    for i, t in rows:
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = WORD.findall(t)
        out.append((i, {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()))
    return out


def plain_documents(rows):
    sets = plain_sets(rows)
    inverse = defaultdict(set)
    for k, (i, s) in enumerate(sets):
        for x in s if i is not None else ():
            inverse[x].add(k)
    links = []
    for k, (i, s) in enumerate(sets):
        near = Counter(m for x in s for m in inverse[x] if m > k) if i is not None else {}
        links += [(i, sets[m][0]) for m, both in near.items() if 100 * both >= 75 * (len(s) + len(sets[m][1]) - both)]
    root = plain_components({i for i, _ in rows if i is not None}, [p for p in links if p[0] != p[1]])
    return Counter((i, len(s), root.get(i)) for i, s in sets)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.integers(len(words))] = f"w{rng.integers(1e9)}"
    return words


def test_near_documents_of_all_sizes(spark):
    """Groups of near copies on both sides of the threshold, from one word to thousands; a passage in all of them."""
    rng = np.random.default_rng(5)
    rows, common = [], [f"c{k}" for k in range(40)]
    for size in (1, 2, 3, 4, 5, 6, 7, 8, 12, 20, 45, 90, 180, 330, 420, 700, 2500):
        base = [f"w{k}" for k in rng.integers(0, 10**9, size)]
        for _ in range(12):
            new = edited(rng, base, int(rng.integers(0, max(2, size // 28))))
            rows.append((len(rows), " ".join([*new, *(common if size > 80 else [])])))
    chain = [f"w{k}" for k in rng.integers(0, 10**9, 400)]
    for step in range(12):
        rows.append((len(rows), " ".join(chain[step * 12 : 200 + step * 12])))
    order = rng.permutation(len(rows)).tolist()
    rows = [(order[i], t) for i, t in rows] + [rows[0], rows[40], (None, rows[40][1]), (7000, rows[3][1].upper())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as id", "2 as n", "'x' as root")
    got = jaccard.near_documents(df.repartition(3))
    assert Counter(map(tuple, got.collect())) == plain_documents(rows)


def test_near_documents_of_messy_rows(spark, messy, nothing):
    rows = [(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()]
    assert Counter(map(tuple, jaccard.near_documents(messy).collect())) == plain_documents(rows)
    assert jaccard.near_documents(nothing).collect() == []


def test_near_documents_of_one_id_with_two_texts(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(30)) for x in "ab")
    df = spark.createDataFrame([(1, a), (5, a), (5, b), (9, b)], "doc_id bigint, text string")
    assert {(r["doc_id"], r["component_id"]) for r in jaccard.near_documents(df).collect()} == {(1, 1), (5, 1), (9, 1)}


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert Counter(map(tuple, jaccard.near_documents(df).collect())) == plain_documents(rows)


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(6)
    for n in (1, 5, 60, 900):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.r_[a[: n // 2], rng.integers(0, 1 << 63, n // 3).astype(np.uint64)])
        far = jaccard.sketch_distance(jaccard.parity_sketch(a), jaccard.parity_sketch(b))
        assert far <= len(np.setxor1d(a, b))
        assert jaccard.sketch_distance(jaccard.parity_sketch(a), jaccard.parity_sketch(a[: n // 3])) <= n - n // 3


def linked_pair(rng, n):
    """Two sets as far apart as a link allows, the first of n shingles; None where rounding forbids it."""
    t = int(rng.integers(-(-3 * n // 4), 4 * n // 3 + 1))
    apart = (n + t) // 7
    apart -= (apart - (t - n)) % 2
    gone = (apart - (t - n)) // 2
    if gone < 0 or apart < gone:
        return None
    a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
    b = np.unique(np.r_[a[rng.permutation(len(a))[gone:]], rng.integers(0, 1 << 63, apart - gone).astype(np.uint64)])
    return a, b


def test_linked_sets_share_one_of_their_least_keys():
    rng = np.random.default_rng(7)
    sizes = [*range(1, 140), 200, 301, 500, 900, 2000, 5000]
    found = [p for n in sizes for _ in range(6) if (p := linked_pair(rng, n))]
    assert len(found) > 400
    for a, b in found:
        for single in (frozenset(), frozenset(k for s in (a, b) for k, *_ in jaccard.bands(len(s)))):
            thin = single | set(jaccard.thin_bands(a)) | set(jaccard.thin_bands(b))
            one, two = (jaccard.sketch_keys(s, thin) for s in (a, b))
            assert len(np.intersect1d(one, two))
            assert max(len(one), len(two)) <= 0.65 * max(len(a), len(b)) + 2
        far = jaccard.short_distance([jaccard.short_sketch(s).tobytes() for s in (a, b)])(np.array([0]), np.array([1]))
        assert far[0] <= len(np.setxor1d(a, b))


def test_a_set_that_fills_few_places_is_thin():
    """Shingles chosen to fall into one place of the set's bands: too few keys, so the band must be single."""
    rng = np.random.default_rng(8)
    (band, places, most), *_ = jaccard.bands(300)
    s = np.unique(rng.integers(0, 1 << 63, 60_000).astype(np.uint64))
    s = s[(jaccard.mix(s ^ np.uint64(band)) % np.uint64(places)) < 3][:300]
    assert band in jaccard.thin_bands(s) and len(jaccard.place_keys(s, band, places)) <= most
    assert len(jaccard.sketch_keys(s, frozenset(jaccard.thin_bands(s)))) > most


def test_sets_of_one_digest_are_counted_apart(spark):
    """Two sets with the same first digest: the lonely shingles of one are not the other's."""
    sets = [np.arange(1, 6, dtype=np.uint64) << np.uint64(20), np.arange(4, 9, dtype=np.uint64) << np.uint64(20)]
    dealt = jaccard._deal_shingles(sets, np.array([7, 7]), np.array([1, 2]), np.array([0], np.int32))
    df = spark.createDataFrame(dealt.to_pandas(), jaccard._DEALT_KIND)
    assert sorted(map(tuple, jaccard._count_lonely(df).collect())) == [(7, 1, 3), (7, 2, 3)]


def _by_partitions(spark, n, make):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        return make()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_sets_meet_once_whatever_the_buckets(spark):
    """Two near copies share dozens of keys: one meeting, whether those lie in three buckets or in forty."""
    rng = np.random.default_rng(11)
    a = np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    far = np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    rows = [(i, s.astype("<u8").tobytes(), i, len(s), jaccard.parity_sketch(s).tobytes()) for i, s in ((1, a), (2, a[8:]), (3, far))]
    sets = spark.createDataFrame(rows, "id bigint, shingles binary, root bigint, n bigint, sketch binary")
    for n in (3, 40):
        met, pairs = _by_partitions(spark, n, lambda: (jaccard.meetings(sets, frozenset()).collect(), jaccard.cross_pairs(sets, frozenset()).collect()))
        assert sorted(r["id"] for r in met) == [1, 2] and len({r["mark"] for r in met}) == 1
        assert [tuple(r) for r in pairs] == [(1, 2)]


def test_lonely_counts_by_chunks_and_buckets(spark):
    """Sets dealt in several chunks, copies among them, against dictionaries; sets that share nothing get no answer."""
    rng = np.random.default_rng(12)
    sets = [np.unique(rng.integers(0, 1 << 63, k).astype(np.uint64)) for k in (3, 40, 300, 2000, 9000)]
    sets += [np.unique(np.r_[s[::2], rng.integers(0, 1 << 63, 5).astype(np.uint64)]) for s in sets] + sets[1:3]
    groups = [0, 1, 2, 3, 4, 5, 1, 7, 8, 9, 1, 2]
    owners = [*range(10), 1, 2]
    part = lambda s, n: s[(s >> np.uint64(11)).astype(float) / 2.0**53 < jaccard._share(n)].tolist()
    holders = defaultdict(set)
    for s, g in zip(sets, groups, strict=True):
        for x in part(s, 0.75 * len(s)):  # what a partner of three quarters of its size is judged by
            holders[x].add(g)
    want = {(o, g): sum(len(holders[x]) == 1 for x in part(s, len(s))) for s, o, g in zip(sets, owners, groups, strict=True)}
    for size in (1, 5):
        buckets = np.arange(size, dtype=np.int32)
        dealt = [jaccard._deal_shingles(sets[a:b], np.array(owners[a:b]), np.array(groups[a:b]), buckets, a) for a, b in ((0, 4), (4, 11), (11, 12))]
        assert max(len(x) for x in dealt) <= size + 1
        df = spark.createDataFrame(pa.Table.from_batches(dealt).to_pandas(), jaccard._DEALT_KIND)
        assert {(r[0], r[1]): r[2] for r in jaccard._count_lonely(df).collect()} == {k: v for k, v in want.items() if v}
    alone = jaccard._deal_shingles(sets[:2], np.array([1, 2]), np.array([1, 2]), np.array([0], np.int32)).to_pylist()
    assert jaccard._shared([[alone[0][c] for c in ("low", "at", "groups", "runs")]]) == [(b"", b"")]


def test_open_sets_are_dealt_out_at_every_size(sample, monkeypatch):
    """Small lists of open ids aren't broadcast, so what is shuffled grows with the table from the start."""
    plans, real = [], jaccard.cross_pairs

    def look(sets, *args, **options):
        plans.append(sets._jdf.queryExecution().executedPlan().toString())
        return real(sets, *args, **options)

    monkeypatch.setattr(jaccard, "cross_pairs", look)
    jaccard.near_documents(sample).collect()
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]
