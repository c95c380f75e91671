"""Readers and writers of the file shapes that runs and data sets come in."""

from __future__ import annotations

import json
import os
import shlex
import tarfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gradeloom.session import cut


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str | None = None, ordinals: bool = False) -> DataFrame:
    """A row per non-blank line: `line` as it stands (identities are hashes of it), its fields if a schema is given, and
    `ordinal`, a number that grows in file order, if asked for."""
    df = spark.read.text(path).withColumnRenamed("value", "line").filter("trim(line) <> ''")
    if ordinals:
        df = df.withColumn("ordinal", F.monotonically_increasing_id())
    return df if schema is None else df.withColumn("_r", F.from_json("line", schema)).select(*[c for c in df.columns], "_r.*")


def write_jsonl(df: DataFrame, path: str, line: str = "line") -> None:
    """The canonical lines of df as text; the commit protocol makes it appear whole or not at all."""
    df.select(F.col(line).alias("value")).write.text(path)


def write_json(value, path: str) -> None:
    """A small report, indented, written beside and then renamed."""
    with open(f"{path}.partial", "w") as f:
        json.dump(value, f, indent=2, ensure_ascii=False)
    os.replace(f"{path}.partial", path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header. Only with multi_line may cells hold line breaks; each file is then one task."""
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """One file with a header, nulls as empty cells."""
    df.coalesce(1).write.option("header", True).option("emptyValue", "").option("nullValue", "").csv(path)


def read_tar_members(spark: SparkSession, path: str, members: list[str], lines: int | dict[str, int] = 256) -> DataFrame:
    """`member`, `ordinal`, `line`: the first lines of the allowed regular members of tar.gz archives, read as a stream by one task
    per archive and written as a table; missing members are an error. lines: for all, or by member (256 for the others)."""
    allowed, most = set(members), lines if isinstance(lines, dict) else dict.fromkeys(members, lines)

    def run(batches):
        import itertools

        import pandas as pd
        from pyarrow import fs

        for pdf in batches:
            for name in pdf["path"]:
                where, inner = fs.FileSystem.from_uri(name if "://" in name else "file://" + name.removeprefix("file:"))
                with where.open_input_stream(inner, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
                    for m in tar:
                        if m.isfile() and m.name in allowed:
                            rows = [(m.name, i, x.decode("utf-8", "replace").rstrip("\r\n")) for i, x in enumerate(itertools.islice(tar.extractfile(m), most.get(m.name, 256)))]
                            yield pd.DataFrame(rows, columns=["member", "ordinal", "line"])

    paths = spark.read.format("binaryFile").load(path).select("path")
    got = cut(paths.repartition("path").mapInPandas(run, "member string, ordinal long, line string"), "tar")
    found = {r.member for r in got.select("member").distinct().collect()}  # at most the allowed ones
    if allowed - found:
        raise FileNotFoundError(f"not in the archive: {sorted(allowed - found)}")
    return got


def source_files(files: list[str], config: str | None, split: str) -> list[str]:
    """The raw JSON Lines files of a source that belong to a configuration; files for validation are left out of training."""
    return [f for f in files if f.endswith(".jsonl") and (not config or config in f) and not (split == "train" and "validation" in f)]


def locked_revision(repo: str, pins: dict[str, str]) -> str:
    """The pinned revision of a source; one without a pin is refused."""
    if repo not in pins:
        raise ValueError(f"{repo} has no pinned revision")
    return pins[repo]


def cached_source(spark: SparkSession, root: str, task: str, version: str, build) -> tuple[DataFrame, dict]:
    """(admitted rows, audit) of a source, built once per version of its adapter: build() gives rows with `reason`. The audit holds
    seen, eligible, rejections by reason, status. A build that fails leaves status 'source_error' and nothing that could be taken
    for a whole source; rows appear with the commit of the write."""
    path, jvm = f"{root}/adapted/{task}/{version}", spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(f"{path}/audit.json")
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hadoop):
        return spark.read.parquet(f"{path}/rows"), json.loads(spark.read.text(f"{path}/audit.json", wholetext=True).first()[0])
    audit = {"task": task, "version": version, "seen": 0, "eligible": 0, "rejections": {}, "status": "ok"}
    try:
        every = cut(build(), "source")
        counts = {r.reason: r["count"] for r in every.groupBy("reason").count().collect()}  # one row per reason
        audit |= {"seen": sum(counts.values()), "eligible": counts.get(None, 0), "rejections": {k: v for k, v in counts.items() if k is not None}}
        rows = every.filter("reason is null").drop("reason")
        rows.write.mode("overwrite").parquet(f"{path}/rows")
    except Exception as e:
        return spark.createDataFrame([], "id string"), audit | {"status": "source_error", "error": f"{type(e).__name__}: {e}"[:500]}
    out = fs.create(hadoop, True)
    out.write(bytearray(json.dumps(audit).encode()))
    out.close()
    return spark.read.parquet(f"{path}/rows"), audit


def append_samples(records: DataFrame, path: str) -> None:
    """Finished records into the sample store: a table by task, to which runs only append. Readers keep the last write per (id,
    sample), so a repeated append changes nothing."""
    records.write.mode("append").partitionBy("task").parquet(path)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """The last stored record per (id, sample) of a sample store."""
    from pyspark.sql import Window

    d = spark.read.parquet(path)
    w = Window.partitionBy("id", "sample").orderBy(F.desc("stored_at"), F.desc(F.xxhash64(*[c for c in d.columns if not d.schema[c].dataType.typeName() == "map"])))
    return d.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """`run` and `metrics` (JSON text) of each finished run below a folder; folders whose name starts with a dot are no runs."""
    try:
        d = spark.read.text(f"{root}/*/metrics.json", wholetext=True)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "run string, metrics string")
    run = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return d.select(run.alias("run"), F.col("value").alias("metrics")).filter(~F.col("run").startswith("."))


def short_path(path: Column, root: str) -> Column:
    """A path without the folder it is below; others, and those equal to it, stay whole. Slashes at the end fall away."""
    p, r = F.regexp_replace(path, "/+$", ""), root.rstrip("/")
    return F.when(p.startswith(r + "/"), F.substr(p, F.lit(len(r) + 2))).otherwise(p) if r else p


def percent(c: Column) -> Column:
    """Hundredfold with two places, halves to the even digit, as tables show it."""
    return F.bround(100 * c, 2)


def compare_runs(metrics: DataFrame, domains: list[str], root: str = "") -> DataFrame:
    """One row per run, best first, runs without a score last: `place`, run, aggregate, its pass@k by k, every domain's score and
    pass@k, what the run was (model and its path below root, judge, split, tasks, limit, samples, context, sampling), truncated samples
    and errors. metrics: run, metrics and, if there are any, config (JSON text) and launch (a map of settings). An aggregate that an old file lacks is the mean of its domains. Percentages; what a run lacks is null."""
    from pyspark.sql import Window

    v = F.try_parse_json("metrics")
    num = lambda p: F.try_variant_get(v, p, "double")
    scores = [num(f"$.domains.{d}.score") for d in domains]
    have = F.filter(F.array(*scores), lambda x: x.isNotNull())
    rebuilt = F.when(F.size(have) > 0, 100 * F.aggregate(have, F.lit(0.0), lambda a, x: a + x) / F.size(have))
    ks = F.try_variant_get(v, "$.pass_k", "array<int>")
    passes = F.try_variant_get(v, "$.aggregate_pass_at_k", "map<string,double>")
    cfg = F.try_variant_get(F.try_parse_json("config"), "$.config", "variant") if "config" in metrics.columns else F.lit(None).cast("variant")
    conf = lambda p, of="string": F.try_variant_get(cfg, p, of)
    launch = lambda k: F.try_element_at("launch", F.lit(k)) if "launch" in metrics.columns else F.lit(None).cast("string")
    model = F.coalesce(conf("$.MODEL_NAME"), launch("MODEL_NAME"))
    what = {
        "model_path": F.coalesce(F.nullif(short_path(launch("MODEL_PATH"), root), F.lit("")), model), "model": model, "judge": F.coalesce(conf("$.JUDGE_NAME"), launch("JUDGE_NAME")), "split": conf("$.SPLIT"), "tasks": F.coalesce(F.nullif(conf("$.TASKS"), F.lit("")), F.lit("all")),
        "limit_per_task": conf("$.LIMIT_PER_TASK", "int"), "n_samples": F.try_variant_get(v, "$.n_samples", "int"), "model_context": conf("$.MODEL_CONTEXT", "int"), "temperature": conf("$.MODEL_SAMPLING.temperature", "double"), "top_p": conf("$.MODEL_SAMPLING.top_p", "double"), "top_k": conf("$.MODEL_SAMPLING.top_k", "int"),
        "complete": F.coalesce(F.try_variant_get(v, "$.aggregate_complete", "boolean"), F.try_variant_get(v, "$.valid_full_benchmark", "boolean")), "truncated": F.try_variant_get(v, "$.truncated_samples", "int"), "errors": F.try_variant_get(v, "$.infrastructure_errors", "int"),
    }
    by_k = lambda p: F.transform_values(F.map_filter(F.try_variant_get(v, p, "map<string,double>"), lambda k, x: x.isNotNull()), lambda k, x: F.bround(100 * x, 2))
    d = metrics.select("run", F.bround(F.coalesce(num("$.aggregate_score_0_100"), rebuilt), 2).alias("aggregate"), F.transform(F.array_sort(ks), lambda k: F.struct(k.alias("k"), F.bround(F.try_element_at(passes, k.cast("string")), 2).alias("score"))).alias("pass_at_k"), *[percent(s).alias(n) for n, s in zip(domains, scores)], *[by_k(f"$.domains.{n}.pass").alias(f"{n}_pass") for n in domains], *[c.alias(n) for n, c in what.items()])
    return d.withColumn("place", F.row_number().over(Window.orderBy(F.desc_nulls_last("aggregate"), "run")))


def pct(value: float | None) -> str:
    """41.2%, or a dash where there is no value."""
    return "\u2014" if value is None else f"{100 * value:.1f}%"


def clock(seconds: float) -> str:
    """1h02m or 3m04s."""
    s = int(seconds)
    return f"{s // 3600}h{s // 60 % 60:02d}m" if s >= 3600 else f"{s // 60}m{s % 60:02d}s"


def read_record_files(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """(records, problems) of one JSON file per record, named <id>.<sample>.json. What cannot be read, or is named
    otherwise than its content says, is a problem and not an error."""
    raw = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.col("value").alias("text"))
    r = raw.withColumn("r", F.from_json("text", schema))
    issue = F.when(F.col("r").isNull() | F.col("r.id").isNull() | F.col("r.sample").isNull(), "unreadable").when(F.concat(F.col("r.id"), F.lit("."), F.col("r.sample").cast("string"), F.lit(".json")) != F.col("file"), "name")
    marked = r.withColumn("issue", issue)
    return marked.filter("issue is null").select("file", "r.*"), marked.filter("issue is not null").select("file", "issue")


def parse_settings(text: str) -> dict[str, str]:
    """KEY='value' lines, or [KEY]=value entries of a saved script with comments behind them, unquoted as a shell does."""
    out = {}
    for line in map(str.strip, text.splitlines()):
        key, sign, value = line.removeprefix("export ").partition("=")
        entry = key.startswith("[") and key.endswith("]")
        key = key.strip("[] ")
        if sign and key.isidentifier():
            out[key] = "".join(shlex.split(value, comments=entry))
    return out


def markdown_table(columns: list[str], rows: list[tuple]) -> str:
    """A padded table of a small, already collected frame; nulls are empty."""
    cells = [[("" if v is None else str(v)).replace("|", "\\|") for v in r] for r in rows]
    width = [max([len(c), 3, *(len(r[i]) for r in cells)]) for i, c in enumerate(columns)]
    line = lambda r: "| " + " | ".join(v.ljust(w) for v, w in zip(r, width)) + " |"
    return "\n".join([line(columns), line(["-" * w for w in width]), *map(line, cells)])
