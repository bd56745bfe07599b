"""Writers: snapshots, loads, materialisation, quarantine, reports."""
