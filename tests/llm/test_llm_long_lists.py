"""Near-duplicates where many documents share much of their text, against brute force; and components with centres."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import components_by_hand

from sparkweft.llm import components, neardup


@pytest.mark.parametrize(("share", "short", "block"), [(0.6, 4, 16), (0.85, 4, 16), (0.9, 8, 8), (0.3, 32, 1024)])
def test_families_of_a_template(spark, monkeypatch, share, short, block):
    """A template fills part of every text; some texts are near copies of others besides."""
    monkeypatch.setattr(neardup, "SHORT", short)
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = np.random.default_rng(int(share * 100))
    template = [f"t{i}" for i in range(int(80 * share))]
    rows = []
    for i in range(240):
        own = [f"u{i}x{j}" for j in range(80 - len(template))]
        rows.append((len(rows), " ".join(template + own)))
        if i % 6 == 0:  # a near copy: some own words changed
            own = [w if rng.random() > 0.15 else w + "y" for w in own]
            rows.append((len(rows), " ".join(template + own)))
        if i % 40 == 0:
            rows.append((len(rows), rows[-1][1].upper()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, words=2).collect()}
    assert got == components_by_hand(rows, 2)


def test_centres(spark, monkeypatch):
    """Nodes with more neighbours than HEAVY are met without a shuffle of their edges, with the same result."""
    monkeypatch.setattr(components, "HEAVY", 3)
    rng = np.random.default_rng(5)
    edges = [(0, i) for i in range(1, 60)] + [(1000 + i, 2000) for i in range(50)] + [(int(a), int(b)) for a, b in rng.integers(3000, 3200, (150, 2))] + [(59, 1000), (7, 7)]
    parent: dict[int, int] = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((top(a), top(b)))
            parent[b] = a
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in nodes}


def test_rarest_shingles_meet(spark):
    """Any two sets that are similar enough have a posted shingle in common, whatever the counts."""
    rng = np.random.default_rng(9)
    counts = rng.integers(0, 50, 1 << neardup.BUCKET_BITS)
    rows, kept = [], []
    for i in range(60):
        a = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 60)), dtype=np.uint64))
        lose = rng.random(len(a)) > 0.12
        b = a[lose] if lose.any() else a
        rows += [(2 * i, np.sort(a).astype(np.int64).tolist()), (2 * i + 1, np.sort(b).astype(np.int64).tolist())]
        kept.append(100 * len(b) >= 80 * len(a))
    sets = spark.createDataFrame(rows, "id long, found array<long>")
    posts = sets.mapInArrow(neardup._rarest(counts, 80), "token long, rep long").groupBy("rep").agg(F.collect_set("token").alias("t")).collect()
    own = {r.rep: set(r.t) for r in posts}
    assert sum(kept) > 20 and all(own[2 * i] & own[2 * i + 1] for i, k in enumerate(kept) if k)


def test_steps_leave_no_tables(spark):
    """What a step wrote goes when the next has what it needs: rows and representatives stay, for the result to read."""
    from sparkweft import tables

    before = tables.mark(spark)
    docs = spark.createDataFrame([(i, f"a b c d e f g h i j {i // 2}") for i in range(40)], "doc_id long, text string")
    result = neardup.near_duplicates(docs, words=2)
    made = tables._made[spark.sparkContext.applicationId][before:]
    assert [p.rpartition("/")[2].rpartition("-")[0] for p in made] == ["dedup-rows", "dedup-reps"]
    assert result.count() == 40 and result.where("component_id = doc_id").count() > 0


def test_written_leaves_no_shuffle_files(spark):
    """A written table needs none of its query's shuffle files, and the session's setting stays as it was."""
    from sparkweft import tables

    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {x.name() for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks.getAllBlocks()) if x.isShuffle()}
    before = held()
    made = tables.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.collect_list("id").alias("x")), "swept")
    assert held() <= before and made.count() == 7 and spark.conf.get(tables.SWEEP, None) is None


def test_agreeing_rows_of_a_block():
    """Rows that agree with none of another component bring no set to the block."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    own = rng.integers(0, 1 << 32, (4, neardup.COORDINATES), dtype=np.uint32)
    own[2, :40] = own[0, :40]  # the stray 2 agrees with member 0; member 1 and stray 3 with none
    group = pa.table({"token": [5] * 4, "rep": [0, 1, 2, 3], "component": [0, 0, 2, 3], "stray": [False, False, True, True], "tokens": [[5]] * 4, "n": [10] * 4, "signature": [x.tobytes() for x in own]})
    assert neardup._near(80)(group).column("rep").to_pylist() == [0, 2]
