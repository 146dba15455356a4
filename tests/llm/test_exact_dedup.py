"""Exact duplicates against plain Python, with clashing fingerprints and small blocks."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fieldmart.llm import exact_dedup


def plain(rows):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = defaultdict(list)
    for d, t in rows:
        groups[low(t)].append(d)
    out = []
    for d, t in rows:
        ids = groups[low(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((d, keep, len(ids)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [512, 4096])
def test_documents(awkward, block_bytes):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    found = exact_dedup.exact_duplicates(awkward, block_bytes=block_bytes).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == plain(rows)
    assert sum(r.kept for r in found) == len({exact for exact in (r.text_sha256 for r in found)})
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_clashing_fingerprints_are_seen(spark):
    def poor(block, seed):
        full = exact_dedup.fingerprint(block, seed)
        return full if seed else [F.length(block).cast("long"), F.lit(0).cast("long")]

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["abcd", "abce", "ABCD", "abcdabcd", "abcdabce", "xbcd", "abcdabcdx"])], "doc_id long, text string")
    found = exact_dedup.exact_duplicates(docs, block_bytes=4, marks=poor).collect()
    assert sorted((r.doc_id, r.keep_id) for r in found) == [(0, 2), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6)]


def test_stage(awkward, nothing):
    kept = exact_dedup.drop_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len({(r.text or "").replace("THE", "the").replace("The", "the") for r in awkward.collect()})
    assert exact_dedup.drop_duplicates(nothing).count() == exact_dedup.exact_duplicates(nothing).count() == 0


def test_no_python_in_plan(awkward):
    plan = exact_dedup.exact_duplicates(awkward)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
