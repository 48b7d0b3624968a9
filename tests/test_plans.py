"""Plan shape: built-ins only in core paths, pruning and pushdown reach the
scan, bounded broadcasts, range-partitioned global order."""
import re

from panelspark.plans import q_corpus, q_holdings, q_misc, q_panel
from panelspark.plans.inspect import plan_text, python_nodes

SF = "/root/testdata/sf0.001"


def read_schemas(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


def test_flagship_plan(spark):
    df = q_holdings.flagship(spark, SF)
    t = plan_text(df)
    assert python_nodes(df) == []
    schemas = read_schemas(t)
    assert any(s.replace(" ", "") == "l_orderkey:bigint,l_partkey:bigint,l_quantity:double" for s in schemas), schemas
    assert "GreaterThan(l_quantity,0.0)" in t
    assert "GreaterThan(c_acctbal,0.0)" in t


def test_core_paths_have_no_python(spark):
    for fn in (q_corpus.mlm08_training_rows, q_corpus.tok06_vocabulary, q_panel.lay02, q_panel.aln05_side_by_side,
               q_misc.sta03_running, q_holdings.hld09_pipeline_baskets):
        assert python_nodes(fn(spark, SF)) == [], fn.__name__


def test_layout7_column_pruning(spark):
    t = plan_text(q_panel.lay07(spark, SF))
    cols = {c.split(":")[0] for s in read_schemas(t) for c in s.split(",")}
    assert cols == {"l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax"}


def test_axis_semi_joins_broadcast(spark):
    t = plan_text(q_panel.lay01(spark, SF))
    assert "BroadcastHashJoin" in t and "LeftSemi" in t


def test_vocabulary_uses_range_partitioning(spark):
    from panelspark.operators import corpus as C
    sent = q_corpus._sent(spark, SF)
    counts = C.token_counts(sent)
    from panelspark.operators.indexing import sorted_tagged
    from pyspark.sql import functions as F
    s = counts.repartitionByRange(4, F.col("count").desc(), "token")
    assert "rangepartitioning" in plan_text(s).lower()
    # the tagged, checkpointed table reads back without recomputing the shuffle
    tagged = sorted_tagged(counts, [F.col("count").desc(), F.col("token")], num_partitions=4)
    assert "Exchange" not in plan_text(tagged.select("token"))


def test_partitionless_windows_only_over_partition_offsets(spark):
    """Global orders never put the data in one window partition: any window
    without a partition key orders by the partition id, i.e. runs over the
    per-partition offsets table (one row per partition)."""
    uses_global_index = {"tok06_vocabulary", "mlm11_batches"}
    for fn in (q_corpus.tok06_vocabulary, q_corpus.mlm11_batches, q_misc.sta03_running,
               q_holdings.hld06_basket_items):
        text = plan_text(fn(spark, SF), "simple")
        seen = 0
        for line in text.splitlines():
            # partition-less: the window spec starts directly with an ordering
            if "Window [" in line and re.search(r"windowspecdefinition\([^,()]*(ASC|DESC)", line):
                seen += 1
                assert "_pid" in line, (fn.__name__, line.strip()[:200])
        if fn.__name__ in uses_global_index:
            assert seen >= 1, fn.__name__  # the offsets window is there and was recognised
