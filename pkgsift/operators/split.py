"""Exact stratified train / validation / test split (E7), F4 merge, S1 sink.

Sizes follow the two-stage rule (test first, then validation as
``val/(1-test)`` of the rest), computed in double arithmetic exactly as
scikit-learn does: ``n_test = ceil(test * n)``, ``n_val = ceil(val/(1-test) * m)``.
Per-class quotas: floor of the proportional share, then the leftover seats
go to the largest remainders (ties by label).  Inside a class, rows are
ordered by ``md5(seed|key)``, then key.

Scale: no class is ranked as a whole.  Test and validation are the first
rows of a class in that order, so only the places where the order is cut have
to be found: counts per (label, md5 prefix) name the bucket of each cut, and
counts per key inside those few buckets name the key.  Every other row
compares its hash with its class's cuts, in a projection.  Copies of a cut key
that are only partly taken are numbered per input partition, with offsets from
counts, so a third of all rows being copies of one key is still many tasks' work.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 4096
SPLITS = ("train", "validation", "test")


def _hash(seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.lit("|"), key))


def _largest_remainder(counts: DataFrame, total: Column, seats: Column, size_col: str,
                       out: str) -> DataFrame:
    """Per class: floor(seats * size / total) + 1 for the largest remainders."""
    w_all = Window.partitionBy()
    w_rank = Window.orderBy(F.col("_rem").desc(), F.col("label"))
    return (counts
            .withColumn("_share", (seats * F.col(size_col)).cast("bigint"))
            .withColumn("_total", total.cast("bigint"))
            .withColumn("_fl", F.expr("CASE WHEN _total > 0 THEN _share div _total ELSE 0 END").cast("bigint"))
            .withColumn("_rem", F.expr("CASE WHEN _total > 0 THEN _share % _total ELSE 0 END"))
            .withColumn("_left", seats - F.sum("_fl").over(w_all))
            .withColumn(out, (F.col("_fl") + F.when(F.row_number().over(w_rank) <= F.col("_left"), 1)
                              .otherwise(0)).cast("bigint"))
            .drop("_share", "_total", "_fl", "_rem", "_left"))


def class_quotas(df: DataFrame, label_col: str = "label", val_size: float = 0.10,
                 test_size: float = 0.10, counts: DataFrame | None = None) -> DataFrame:
    """(label, n_c, n_test_c, n_val_c): one row per class (tiny).

    ``counts`` (label, n_c) may be given when already computed.
    """
    if not (0 < test_size < 1 and 0 <= val_size < 1 and val_size + test_size < 1):
        raise ValueError("need 0 < test_size < 1, 0 <= val_size and val_size + test_size < 1")
    vr = val_size / (1.0 - test_size)
    if counts is None:
        counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n_c"))
    w_all = Window.partitionBy()
    counts = (counts.withColumn("_n", F.sum("n_c").over(w_all))
              .withColumn("_k", F.count(F.lit(1)).over(w_all))
              .withColumn("_n_test", F.ceil(F.lit(float(test_size)) * F.col("_n")).cast("bigint")))
    # scikit-learn refuses these inputs; so do we (lazily, when the plan runs)
    counts = counts.withColumn("_check", F.when(
        F.min("n_c").over(w_all) < 2,
        F.raise_error(F.lit("the least populated class has fewer than 2 members")))
        .when(F.col("_n_test") < F.col("_k"),
              F.raise_error(F.lit("test split is smaller than the number of classes"))))
    t = _largest_remainder(counts, F.col("_n"), F.col("_n_test"), "n_c", "n_test_c")
    t = (t.withColumn("_r", F.col("n_c") - F.col("n_test_c"))
         .withColumn("_m", F.col("_n") - F.col("_n_test"))
         .withColumn("_n_val", F.ceil(F.lit(vr) * F.col("_m")).cast("bigint")))
    t = t.withColumn("_check2", F.when(
        (F.lit(val_size) > 0) & (F.col("_n_val") < F.col("_k")),
        F.raise_error(F.lit("validation split is smaller than the number of classes"))))
    v = _largest_remainder(t, F.col("_m"), F.col("_n_val"), "_r", "n_val_c")
    return v.select("label", "n_c", "n_test_c", "n_val_c",
                    F.coalesce(F.col("_check").cast("string"), F.col("_check2").cast("string")).alias("_chk"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it runs once, survives
    lost executors and has known sizes."""
    from pkgsift.sources.sinks import scratch_folder
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cuts(rows: DataFrame, quotas, hexdigits: int) -> DataFrame:
    """(_lab, test, validation) per class: struct(h, take, copies) of the last key
    that belongs to test, and to test or validation; null where that is empty."""
    b = F.substring("_h", 1, hexdigits)
    buckets = _stored(rows.groupBy("_lab", b.alias("_b")).agg(F.count(F.lit(1)).alias("n")), "split-buckets")
    q = quotas(buckets.groupBy(F.col("_lab").alias("label")).agg(F.sum("n").alias("n_c")))
    ranks = q.select(F.col("label").alias("_of"), "_chk", F.inline(F.array(
        F.struct(F.lit(1).alias("k"), F.col("n_test_c").alias("r")),
        F.struct(F.lit(2).alias("k"), (F.col("n_test_c") + F.col("n_val_c")).alias("r")))))
    ends = buckets.withColumn("end", F.sum("n").over(Window.partitionBy("_lab").orderBy("_b")))
    mine = F.col("_lab").eqNullSafe(F.col("_of"))
    # the check column stays a key, so that it is evaluated
    edges = _stored(ends.join(ranks, mine).where("r > 0 AND end >= r").groupBy("_lab", "k", "r", "_chk")
                    .agg(F.min(F.struct("_b", (F.col("end") - F.col("n")).alias("begin"))).alias("e"))
                    .select("_lab", "k", "r", "_chk", "e._b", "e.begin"), "split-edges")
    edge = edges.select(F.col("_lab").alias("_of"), "_b", "k", "r", "begin")
    sought = edge.select("_of", F.col("_b").alias("_eb")).distinct()
    near = rows.withColumn("_b", b).join(sought, mine & (F.col("_b") == F.col("_eb")), "left_semi")
    keys = near.groupBy("_lab", "_b", "_h").agg(F.count(F.lit(1)).alias("copies"))
    keys = keys.withColumn("kend", F.sum("copies").over(Window.partitionBy("_lab", "_b").orderBy("_h")))
    at = (keys.join(edge.withColumnRenamed("_b", "_eb"), mine & (F.col("_b") == F.col("_eb")))
          .where("begin + kend >= r").groupBy("_lab", "k", "r")
          .agg(F.min(F.struct("_h", "copies", (F.col("begin") + F.col("kend") - F.col("copies")).alias("before"))).alias("c"))
          .withColumn("cut", F.struct(F.col("c._h").alias("h"), (F.col("r") - F.col("c.before")).alias("take"), F.col("c.copies").alias("copies"))))
    return _stored(at.groupBy("_lab").agg(F.max(F.when(F.col("k") == 1, F.col("cut"))).alias("test"),
                                          F.max(F.when(F.col("k") == 2, F.col("cut"))).alias("validation")), "split-cuts")


def stratified_split(df: DataFrame, key: Column | None = None, label_col: str = "label",
                     val_size: float = 0.10, test_size: float = 0.10, seed: int = 42,
                     n_buckets: int = DEFAULT_BUCKETS, materialize: bool = True) -> DataFrame:
    """Add ``split`` ∈ {train, validation, test} with exact per-class sizes.

    ``key`` orders rows inside a class (default: all columns joined); rows
    with equal keys are interchangeable.  The input is read three times (bucket
    counts, cut buckets, result); with ``materialize`` it is first written to the
    shared folder, so an expensive upstream plan (feature extraction) runs once.
    """
    if materialize:
        df = _stored(df, "split-input")
    if key is None:
        key = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000"))
                                       for c in df.columns])
    hexdigits = max(1, math.ceil(math.log(max(n_buckets, 2), 16)))
    hashed = df.withColumns({"_lab": F.col(label_col), "_h": _hash(seed, key)})
    cuts = _cuts(hashed.select("_lab", "_h"), lambda counts: class_quotas(df, label_col, val_size, test_size, counts=counts), hexdigits)
    of = cuts.select(F.col("_lab").alias("_of"), F.col("test").alias("_t"), F.col("validation").alias("_v"))
    placed = hashed.join(of, F.col("_lab").eqNullSafe(F.col("_of")), "left")

    def split(number: Column | None) -> Column:
        def within(cut: str) -> Column:
            whole = F.col(f"{cut}.take") == F.col(f"{cut}.copies")
            taken = whole if number is None else whole | (number <= F.col(f"{cut}.take"))
            return (F.col("_h") < F.col(f"{cut}.h")) | ((F.col("_h") == F.col(f"{cut}.h")) & taken)
        return F.when(within("_t"), "test").when(within("_v"), "validation").otherwise("train")

    partly = cuts.where("test.take < test.copies OR validation.take < validation.copies")
    if partly.isEmpty():
        return placed.select(*df.columns, split(None).alias("split"))
    # copies of a key that is cut are numbered by (input partition, place in it)
    on_cut = F.coalesce((F.col("_h") == F.col("_t.h")) & (F.col("_t.take") < F.col("_t.copies")), F.lit(False)) \
        | F.coalesce((F.col("_h") == F.col("_v.h")) & (F.col("_v.take") < F.col("_v.copies")), F.lit(False))
    numbered = placed.withColumns({"_pid": F.spark_partition_id() if materialize else F.lit(0), "_mid": F.monotonically_increasing_id()})
    ties = numbered.where(on_cut)
    seg = ["_lab", "_h", "_pid"]
    before = (ties.groupBy(*seg).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("_off", F.coalesce(F.sum("n").over(Window.partitionBy("_lab", "_h").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select(F.col("_lab").alias("_bl"), F.col("_h").alias("_bh"), F.col("_pid").alias("_bp"), "_off"))
    ranked = (ties.withColumn("_rn", F.row_number().over(Window.partitionBy(*seg).orderBy("_mid")))
              .join(before, F.col("_lab").eqNullSafe(F.col("_bl")) & (F.col("_h") == F.col("_bh")) & (F.col("_pid") == F.col("_bp"))))
    return (placed.where(~on_cut).select(*df.columns, split(None).alias("split"))
            .unionByName(ranked.select(*df.columns, split(F.col("_off") + F.col("_rn")).alias("split"))))


def group_split(df: DataFrame, group_col: str = "package", label_col: str = "label",
                val_size: float = 0.10, test_size: float = 0.10, seed: int = 42,
                n_buckets: int = DEFAULT_BUCKETS, materialize: bool = True) -> DataFrame:
    """Q19 option: a leakage-free split.  Whole groups (e.g. all versions of a
    package) go to one split; the exact stratified rule runs over groups,
    with a group's label the max of its rows' labels (package label, D3).
    Sizes are exact in groups, not rows."""
    if materialize:
        df = _stored(df, "split-input")
    groups = df.groupBy(group_col).agg(F.max(label_col).alias("_glabel"))
    g_split = stratified_split(groups, key=F.col(group_col).cast("string"), label_col="_glabel",
                               val_size=val_size, test_size=test_size, seed=seed,
                               n_buckets=n_buckets, materialize=False)
    return df.join(g_split.select(group_col, "split"), group_col).select(*df.columns, "split")


def leakage_free_split(df: DataFrame, group_col: str = "package", shared: tuple[str, ...] = ("textual_description",),
                       label_col: str = "label", val_size: float = 0.10, test_size: float = 0.10, seed: int = 42) -> DataFrame:
    """Q19 option: add ``split`` so that no ``group_col`` value and no value of the
    ``shared`` columns stands on two sides.

    Rows linked through either, transitively, are one unit.  A unit's label is the
    largest of its rows'; per label the sizes of the exact stratified rule
    (``class_quotas``) are wanted, in rows.  Units larger than a quarter of the smaller
    quota go to train.  Of the others, in an order that ``seed`` shuffles, the
    first ones that fit make up test, the next ones validation, and units of one
    row fill what is missing of either.  So sizes are exact as long as there are
    such units, and short by less than a quarter of the smaller quota otherwise.
    Rows without a group are units of their own with the rows they share a value with.
    """
    from pkgsift.operators.group_components import linked_groups
    from pkgsift.operators.prefix_sums import md5_order, running_total

    own = F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in df.columns]))
    df = _stored(df.withColumn("_node", F.coalesce(F.concat(F.lit("g"), F.col(group_col).cast("string")), F.concat(F.lit("r"), own))), "split-input")
    groups = linked_groups(df, "_node", list(shared))
    rows = _stored(df.join(groups, "_node").drop("_node"), "split-grouped")
    units = _stored(rows.groupBy("group").agg(F.count("*").alias("n"), F.max(label_col).alias("label"))
                    .withColumn("order", md5_order(seed, F.col("group"))), "split-units")
    quotas = class_quotas(units, val_size=val_size, test_size=test_size, counts=units.groupBy("label").agg(F.sum("n").alias("n_c")))
    wanted = _stored(quotas.select(F.col("label").alias("_l"), F.col("n_test_c").alias("t"), F.col("n_val_c").alias("v"), "_chk"), "split-quotas")
    same = F.col("label").eqNullSafe(F.col("_l"))
    small = units.join(wanted, same).where(F.col("n") * 4 <= F.greatest(F.least(F.when(F.col("t") > 0, F.col("t")), F.when(F.col("v") > 0, F.col("v"))), F.lit(4)))
    # test: the units that end within its quota; validation: the next ones within its own
    first = running_total(small.select("group", "n", "label", "order", "t", "v"), ["label"], "order", F.col("n"), "before", ["group"])
    first = _stored(first.withColumn("in_test", F.col("before") + F.col("n") <= F.col("t")), "split-first")
    used = first.groupBy(F.col("label").alias("_ul")).agg(F.coalesce(F.sum(F.when(F.col("in_test"), F.col("n"))), F.lit(0)).alias("ut"))
    second = first.join(used, F.col("label").eqNullSafe(F.col("_ul"))).drop("_ul").withColumn(
        "in_val", ~F.col("in_test") & (F.col("before") - F.col("ut") + F.col("n") <= F.col("v")))
    second = _stored(second, "split-second")
    filled = second.groupBy(F.col("label").alias("_ul")).agg(F.coalesce(F.sum(F.when(F.col("in_val"), F.col("n"))), F.lit(0)).alias("uv"))
    single = ~F.col("in_test") & ~F.col("in_val") & (F.col("n") == 1)
    last = running_total(second.join(filled, F.col("label").eqNullSafe(F.col("_ul"))).drop("_ul"), ["label"], "order", single.cast("int"), "place", ["group"])
    left_test, left_val = F.col("t") - F.col("ut"), F.col("v") - F.col("uv")
    split = (F.when(F.col("in_test"), "test").when(F.col("in_val"), "validation")
             .when(single & (F.col("place") < left_test), "test").when(single & (F.col("place") < left_test + left_val), "validation"))
    placed = last.select("group", split.alias("split")).where("split is not null")
    return rows.join(placed, "group", "left").select(*[c for c in df.columns if c != "_node"], F.coalesce("split", F.lit("train")).alias("split"))


def merge_registries(**frames: DataFrame) -> DataFrame:
    """union of per-registry (textual_description, label, ...) frames + ``ecosystem``."""
    out = None
    for name, f in frames.items():
        f = f.withColumn("ecosystem", F.lit(name))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def split_counts(split_df: DataFrame) -> DataFrame:
    return split_df.groupBy("split", "label").agg(F.count(F.lit(1)).alias("rows"))


def write_splits(split_df: DataFrame, out_dir: str, fmt: str = "parquet",
                 columns=("textual_description", "label")) -> None:
    """Folders ``split=train``, ``split=validation``, ``split=test``, written in
    one pass.  CSV uses RFC-4180 quoting (doubled quotes), as pandas writes."""
    from pkgsift.sources.sinks import write_table
    write_table(split_df.select(*columns, "split"), out_dir, fmt="csv" if fmt == "csv" else "parquet", by="split")


def split_folder(out_dir: str, name: str) -> str:
    """Where ``write_splits`` leaves one split."""
    return f"{out_dir}/split={name}"
