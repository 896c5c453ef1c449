"""Curve: one step at a time through every cell; shards: sizes, order, pruning, odd tables, files."""

import itertools
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.oracle import compare, connect
from tidemark.llm import curve_shards, queries
from tidemark.llm.shared import table
from tidemark.session import work_dir

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize(("n", "bits"), [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, n, bits):
    cells = spark.createDataFrame(list(itertools.product(range(1 << bits), repeat=n)), [f"c{k}" for k in range(n)])
    got = cells.withColumn("i", curve_shards.curve_index([F.col(c) for c in cells.columns], bits)).orderBy("i").collect()
    assert [r["i"] for r in got] == list(range(1 << (n * bits)))
    assert all(sum(abs(x - y) for x, y in zip(p[:n], q[:n], strict=True)) == 1 for p, q in itertools.pairwise(got))


def test_same_as_sql(spark):
    got = queries.QUERIES["op11_hilbert_shards"](spark, SF_DIR).toArrow()
    assert compare(got, connect(SF_DIR).sql(queries.SQL["op11_hilbert_shards"]).to_arrow_table()) is None


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_laws(spark, law):
    docs = table(spark, SF_DIR, "documents")
    rows = curve_shards.shard_documents(docs, 24, law=law).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    shards = defaultdict(list)
    for r in rows:
        shards[r["shard"]].append(r)
    assert sorted(shards) == list(range(24))
    for held in shards.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
        held.sort(key=lambda r: r["slot"])
        assert [r["place"] for r in held] == sorted(r["place"] for r in held)
    if law == "rows":
        assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    else:
        total, longest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
        assert all(abs(sum(r["size"] for r in s) - total / 24) <= longest for s in shards.values())


def test_values_and_odd_rows(spark):
    rows = [(1, "äb", "de", None), (1, "äb", "de", None), (None, None, None, "s"), (None, "", "en", "s"), (2, "x" * 200_000, "en", "t")]
    rows += [(None, "same", "en", "hot")] * 60
    odd = spark.createDataFrame([(*r, 1, "a", 0, 5) for r in rows], f"{SCHEMA}, shard int, tie string, size int, _slice int")
    got = curve_shards.shard_documents(odd, 3).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    for s in {r["shard"] for r in got}:
        held = [r["slot"] for r in got if r["shard"] == s]
        assert sorted(held) == list(range(len(held)))
    # Rows of one point are split over shards.
    assert len({r["shard"] for r in curve_shards.shard_documents(odd.where("text = 'same'"), 4).collect()}) == 4
    assert curve_shards.shard_documents(odd.limit(0), 3).count() == 0
    with pytest.raises(ValueError, match="law"):
        curve_shards.shard_documents(odd, 3, law="keys")


def test_files_prune_by_every_dimension(spark):
    docs = table(spark, SF_DIR, "documents").withColumn("slot", F.lit("own"))
    path = work_dir(spark, "shards")
    bounds = curve_shards.write_shards(docs, path, 24).collect()
    read = spark.read.parquet(path)
    assert read.select(*docs.columns).exceptAll(docs).count() == 0 and read.count() == docs.count()
    assert sum(r["n_rows"] for r in bounds) == docs.count() and len(bounds) == 24
    # A filter on one value of a dimension leaves most shards unread.
    for column, value in (("lang", "de"), ("source", "src9")):
        met = [r for r in bounds if r[f"min_{column}"] <= value <= r[f"max_{column}"]]
        assert len(met) <= 15, (column, len(met))
    assert len([r for r in bounds if r["min_size"] <= 300 <= r["max_size"]]) <= 12
