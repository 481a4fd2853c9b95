"""The reference's data flow end to end:

read -> clean, guard, validate -> exact subset per source -> mix -> render ->
vocabulary -> encode -> batch plan -> truncate, pad, mask -> per-rank shards.

What is rejected is written with its reason. The rendered mix and the vocabulary
are written once and read back, which cuts the lineage and is the artefact the
trainer needs anyway (S7). Shuffles carry keys (the plan) and unpadded ids; mask,
labels and padding are made after the last one.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import SftConfig
from ..functions.text import clean_text, tokenize
from ..operators import batches as bat
from ..operators import sampling as smp
from ..operators import templates as tpl
from ..operators import tokens as tk
from ..operators import validate as val
from ..session import materialize, shared_path
from ..sources.files import file_system
from ..sources.io import read_instruction_json, split_records, write_table
from ..sources.raw_records import RecordShape, read_raw_records


@dataclass(frozen=True)
class TrainingSet:
    vocab_path: str
    shards_path: str
    rejected_path: str
    config_path: str
    manifest_path: str


FIELDS = ["source", "example_id", "instruction", "input", "output"]


def assign_example_ids(rows: DataFrame, source: str) -> DataFrame:
    """Records (instruction, input, output) as examples of ``source``. The id is a hash of
    the record and a running number among equal ones, so it does not depend on files or
    order. Equal records are numbered within partitions of a written table, with offsets
    from counts: a record that makes up much of the input is no single task."""
    if "input" not in rows.columns:
        rows = rows.withColumn("input", F.lit(""))
    text = [F.coalesce(F.col(c), F.lit("")) for c in FIELDS[2:]]
    d = materialize(rows.select(*FIELDS[2:], F.md5(F.concat_ws("\x1f", *text)).alias("h")), "records")
    d = d.withColumn("part", F.spark_partition_id())
    before = Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = d.groupBy("h", "part").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("h").alias("sh"), F.col("part").alias("sp"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at"))
    number = F.row_number().over(Window.partitionBy("h", "part").orderBy(F.lit(0))) + F.col("at")
    d = d.join(starts, (F.col("h") == F.col("sh")) & (F.col("part") == F.col("sp")))
    return d.select(F.lit(source).alias("source"), F.concat_ws("-", "h", number.cast("string")).alias("example_id"),
                    *FIELDS[2:])


def examples_from_json(spark: SparkSession, files: dict[str, str],
                       shapes: dict[str, RecordShape] | None = None) -> tuple[list[DataFrame], DataFrame]:
    """(one example table per source, rejected records) of the JSON files of each source. A source with a shape has raw
    records, which are mapped by its paths; the others have the three fields themselves."""
    tables, bad = [], None
    for source, path in files.items():
        if source in (shapes or {}):
            rows = materialize(read_raw_records(spark, path, shapes[source]), "json")
            good, rejected = rows.where("reason = ''"), rows.where("reason <> ''")
        else:
            good, rejected = split_records(materialize(read_instruction_json(spark, path), "json"))
        tables.append(assign_example_ids(good, source))
        rejected = rejected.select(F.lit(source).alias("source"), "record", "reason")
        bad = rejected if bad is None else bad.unionByName(rejected)
    return tables, bad


def prepare(source: DataFrame, cfg: SftConfig) -> DataFrame:
    """F5, F7, F4 on one source: cleaned and guarded fields, with ``valid`` and ``reason``."""
    if "input" not in source.columns:
        source = source.withColumn("input", F.lit(""))
    d = source.select(*FIELDS)
    if cfg.clean:
        for c in FIELDS[2:]:
            d = d.withColumn(c, clean_text(c))
    if cfg.guard:
        d = val.marker_guard(d).drop("had_marker")
    return val.required_fields(d)


def unique_keys(rows: DataFrame) -> DataFrame:
    """``rows`` (a written table with ``part`` and ``row_id``) with ``uid``, unique within a source: the example id
    where no other row has it, else (and for null ids) the id, the hash of the fields and a running
    number among rows that are alike in all of these. Alike rows are numbered within the parts of the table,
    with offsets from counts, so one that makes up much of the input is no single task."""
    rows = rows.withColumn("h", F.md5(F.to_json(F.struct(*FIELDS))))
    again = (rows.groupBy("source", "example_id").agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1 or example_id is null").select(F.col("source").alias("rs"), F.col("example_id").alias("re")))
    if again.isEmpty():
        return rows.withColumn("uid", F.col("example_id").cast("string")).drop("h", "part")
    again = materialize(again, "repeated-ids")
    meets = rows["source"].eqNullSafe(again["rs"]) & rows["example_id"].eqNullSafe(again["re"])
    alike = ["source", "example_id", "h"]
    some = rows.join(again, meets, "left_semi")
    before = Window.partitionBy(*alike).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = some.groupBy(*alike, "part").agg(F.count(F.lit(1)).alias("n")).select(
        *[F.col(c).alias(f"s_{c}") for c in (*alike, "part")], F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at"))
    number = F.row_number().over(Window.partitionBy(*alike, "part").orderBy("row_id")) + F.col("at")
    numbered = some.join(starts, [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in (*alike, "part")]).withColumn(
        "uid", F.concat_ws("#", F.coalesce(F.col("example_id").cast("string"), F.lit(smp.NULL_PART)), "h", number.cast("string")))
    single = rows.join(again, meets, "left_anti").withColumn("uid", F.col("example_id").cast("string"))
    return materialize(single.unionByName(numbered.select(*single.columns)).drop("h", "part"), "training-rows")


def _there(spark: SparkSession, path: str) -> DataFrame | None:
    """A table that was written to its end, if there is one."""
    fs, name = file_system(path)
    done = fs.get_file_info(f"{name}/_SUCCESS").type == pafs.FileType.File
    return spark.read.parquet(path) if done else None


def build_training_set(spark: SparkSession, sources: list[DataFrame], cfg: SftConfig,
                       out_path: str | None = None, vocab_path: str | None = None,
                       rows_per_file: int = 200_000, also_rejected: DataFrame | None = None,
                       runs_per_commit: int | None = None, resume: bool = False) -> TrainingSet:
    """Writes vocabulary, shards, a manifest of them, rejected rows (with ``also_rejected``: source, record,
    reason) and the parameters; returns their paths.

    ``sources`` are example tables (source, example_id, instruction, output, and
    input or not); each is subset on its own before the mix, as in the reference.
    Every row counts, also one that is there again or whose id is null or not its own (``unique_keys``).

    Shards are written in runs of ``rows_per_file`` positions. With ``runs_per_commit``, so many runs of an epoch are
    written and entered into the manifest at a time (the encoded rows are then a table of their own), and a build that was
    stopped goes on with ``resume``, the same paths, sources and parameters: it takes the tables that are complete
    and writes the runs that the manifest lacks. Runs left half written are replaced.
    """
    if resume and out_path is None:
        raise ValueError("resume needs the out_path of the build to go on with")
    out_path = out_path or shared_path(spark, "shards")
    vocab_path = vocab_path or (f"{out_path}-vocab" if runs_per_commit else shared_path(spark, "vocab"))
    paths = TrainingSet(vocab_path, out_path, f"{out_path}-rejected", f"{out_path}-config", f"{out_path}-manifest")
    kept_path, enc_path = f"{out_path}-rows", f"{out_path}-encoded"
    settings = [(k, str(v)) for k, v in asdict(cfg).items()] + [("rows_per_file", str(rows_per_file))]
    mixed = _there(spark, kept_path) if resume else None
    if mixed is None or _there(spark, paths.config_path) is None:
        mixed = _mix(spark, sources, cfg, also_rejected, paths, kept_path if runs_per_commit else None)
        write_table(tk.build_vocab(mixed, ["prompt", "answer"], cfg.vocab_size), vocab_path)
        write_table(spark.createDataFrame([tuple(v for _, v in settings)], ", ".join(f"{k} string" for k, _ in settings)),
                    paths.config_path)
    elif spark.read.parquet(paths.config_path).first().asDict() != dict(settings):
        raise ValueError(f"{paths.config_path} has other parameters")
    vocab = spark.read.parquet(vocab_path)

    # Ragged rows and the plan, which is made of keys only, meet once; each row
    # appears once per epoch. Contiguous runs of ``rows_per_file`` positions are
    # hash-partitioned as units, and a task writes whole runs in order.
    enc = tk.encode_ids(mixed.select("row_id", "example_id", "prompt", "answer"), vocab, cfg)
    if runs_per_commit:
        if not resume or _there(spark, enc_path) is None:
            write_table(enc, enc_path)
        enc = spark.read.parquet(enc_path)
    plan = bat.batch_plan(mixed.select("source", "source_rank", "uid", "row_id"), cfg.epochs, cfg.batch_size,
                          cfg.grad_accum, cfg.world_size, cfg.seed, key="uid", prefix_hex=cfg.index_prefix_hex,
                          shuffle=cfg.shuffle).drop("source_rank", "uid")
    plan = plan.withColumn("run", F.floor(F.col("pos") / rows_per_file).cast("long"))
    if not runs_per_commit:
        _write_runs(plan, enc, cfg, paths)
        return paths
    plan = materialize(plan, "plan")
    done = spark.read.parquet(paths.manifest_path) if resume and _manifest_exists(paths.manifest_path) else None
    n_runs = -(-mixed.count() // rows_per_file)
    for epoch in range(cfg.epochs):
        for a in range(0, n_runs, runs_per_commit):
            some = plan.where((F.col("epoch") == epoch) & (F.col("run") >= a) & (F.col("run") < a + runs_per_commit))
            if done is not None:
                some = some.join(done.select("epoch", "rank", "run"), ["epoch", "rank", "run"], "left_anti")
            if done is None or not some.isEmpty():
                _write_runs(some, enc, cfg, paths)
    return paths


def _manifest_exists(path: str) -> bool:
    fs, name = file_system(path)
    return fs.get_file_info(name).type == pafs.FileType.Directory


def _mix(spark: SparkSession, sources: list[DataFrame], cfg: SftConfig, also_rejected: DataFrame | None,
         paths: TrainingSet, kept_path: str | None) -> DataFrame:
    """The rendered mix; what is rejected is written."""
    # The sources are read, cleaned and checked once; everything else comes from this table, and
    # a lost executor later recomputes from here.
    checked = materialize(smp.mix_strict(*[prepare(s, cfg).withColumn("source_rank", F.lit(i)) for i, s in enumerate(sources)])
                          .withColumn("part", F.spark_partition_id()).withColumn("row_id", F.monotonically_increasing_id()),
                          "checked")
    rejected = checked.where(~F.col("valid")).select("source", F.to_json(F.struct(*FIELDS[1:])).alias("record"), "reason")
    if also_rejected is not None:
        rejected = rejected.unionByName(also_rejected.select("source", "record", "reason"))
    kept = unique_keys(checked.where("valid").drop("valid", "reason"))
    subset = smp.subset_exact(kept, cfg.train_pct, cfg.seed, "uid", ("source_rank", "source"), cfg.index_prefix_hex)
    mixed = tpl.render(subset, cfg.template)
    columns = ["source", "source_rank", "example_id", "uid", "row_id", "prompt", "answer"]
    if cfg.drop_all_masked:
        fills = F.size(tokenize("prompt")) >= cfg.max_len
        mixed = mixed.withColumn("record", F.when(fills, F.to_json(F.struct(*FIELDS[1:]))))
        mixed = materialize(mixed.select(*columns, "record"), "training-mix")
        rejected = rejected.unionByName(mixed.where(F.col("record").isNotNull()).select(
            "source", "record", F.lit("prompt fills max_len").alias("reason")))
        mixed = mixed.where(F.col("record").isNull()).drop("record")
    else:
        mixed = mixed.select(*columns)
    write_table(rejected, paths.rejected_path)
    return spark.read.parquet(write_table(mixed, kept_path)) if kept_path else mixed


SHARD = ["step", "micro_step", "batch_id", "pos", "source", "example_id", "input_ids", "attention_mask", "labels",
         "prompt_len", "length", "template"]


def _write_runs(plan: DataFrame, enc: DataFrame, cfg: SftConfig, paths: TrainingSet) -> None:
    """Writes the runs of ``plan`` in order, each as one file, then enters what was written into the manifest."""
    spark = plan.sparkSession
    rows = plan.join(enc, "row_id", "inner").repartition("epoch", "rank", "run").sortWithinPartitions("epoch", "rank", "run", "pos")
    out = tk.pad_and_mask(rows, cfg).withColumn("template", F.lit(cfg.template)).select("epoch", "rank", "run", *SHARD)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch", "rank", "run")
     .parquet(paths.shards_path))
    keys = ["epoch", "rank", "run"]
    wrote = plan.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    back = spark.read.parquet(paths.shards_path)
    manifest = (back.join(wrote, [F.col(k) == F.col(f"_{k}") for k in keys], "left_semi").groupBy(*keys).agg(
        F.min("pos").alias("first_pos"), F.min("step").alias("first_step"), F.max("step").alias("last_step"),
        F.count(F.lit(1)).alias("rows"), F.hex(F.bit_xor(F.xxhash64("pos", "source", "example_id", "input_ids"))).alias("digest")))
    manifest.write.mode("append").parquet(paths.manifest_path)


def read_shards(spark: SparkSession, ts: TrainingSet, from_step: int = 0, epoch: int | None = None, rank: int | None = None) -> DataFrame:
    """Rows of the shards that the manifest lists, from optimizer step ``from_step`` of each epoch on. Runs that end before it
    are not opened: the first run that is needed is known from the manifest, and runs are folders."""
    rows = spark.read.parquet(ts.shards_path)
    listed = spark.read.parquet(ts.manifest_path)
    for name, value in (("epoch", epoch), ("rank", rank)):
        if value is not None:
            rows, listed = rows.where(F.col(name) == value), listed.where(F.col(name) == value)
    first = listed.where(F.col("last_step") >= from_step).agg(F.min("run")).first()[0]
    if first is None:
        return rows.limit(0)
    known = listed.select("epoch", "rank", "run").distinct()  # a row per file
    return rows.where((F.col("run") >= first) & (F.col("step") >= from_step)).join(known, ["epoch", "rank", "run"], "left_semi").select(
        *rows.columns)
