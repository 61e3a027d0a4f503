"""File sources and sinks (S1-S13): text logs, delimited tables, labelled
sentence files, word lists, pair files, word-vector text, ranked-run output.

All readers return DataFrames with explicit schemas (no inference pass) and
keep a source order column where line order carries meaning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import materialise, persist


def _decode(value, encoding: str):
    if encoding.lower().replace("-", "") in ("utf8",):
        return value
    # read.text keeps the raw bytes of each line, so a non-UTF-8 file decodes exactly
    return F.decode(value.cast("binary"), encoding)


def _line_order(*before) -> Column:
    """Position of a line in a scan: ``before``, then file, place of the split in its file, and line in the split.
    A bare row number would follow the order in which Spark packs splits, which is by size."""
    return F.struct(*before, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("line"))


def scan_text_lines(spark: SparkSession, path: str | Sequence[str], encoding: str = "utf-8",
                    partitions: int | None = None) -> DataFrame:
    """One row per line, column ``value``. Gzip input is one task per file, so
    pass ``partitions`` to spread the following stages."""
    df = spark.read.text(path if isinstance(path, str) else list(path))
    if encoding.lower().replace("-", "") != "utf8":
        df = df.select(_decode(F.col("value"), encoding).alias("value"))
    if partitions:
        df = df.repartition(partitions)
    return df


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             null_tokens: Sequence[str] = (), **options) -> DataFrame:
    """Delimited table with a given schema."""
    reader = spark.read.schema(schema).option("header", header)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(path)
    if null_tokens:
        from kestrel.operators.clean import token_to_null

        df = token_to_null(df, tuple(null_tokens))
    return df


def scan_csv_noheader(spark: SparkSession, path: str, n_features: int,
                      label_first: bool = True) -> DataFrame:
    """Header-less numeric CSV: ``label`` then ``f1..fn`` doubles (S3)."""
    names = (["label"] + [f"f{i}" for i in range(1, n_features + 1)] if label_first
             else [f"f{i}" for i in range(1, n_features + 1)] + ["label"])
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    return spark.read.schema(schema).option("header", False).csv(path)


def scan_labelled_text(spark: SparkSession, path: str, columns: Sequence[str],
                       label: str = "label") -> DataFrame:
    """CSV of (text, label) or (label, text) in caller order; quoted fields may
    span lines (S4). One large file is read by as many tasks as it has splits (``quoted_records``)."""
    fields = [T.StructField(c, T.IntegerType() if c == label else T.StringType()) for c in columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parsed = quoted_records(spark, path).select(F.from_csv("record", schema, {"quote": '"', "escape": '"'}).alias("r"))
    return parsed.select("r.*")


def quoted_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(record) of a text file whose records may span lines inside quotes; empty lines are no records.

    A line belongs to the record before it if an odd number of quotes lies in front of it. Quotes are counted per split of
    the files first; with the parity that each split begins with, every task knows where its records begin without having
    seen what lies before. Records on one line, as most are, stay where they were read; only the lines of the others are
    brought together, also across splits. Quotes have to be balanced, as in every file of quoted fields.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value",
        F.length(F.regexp_replace("value", f"[^{quote}]", "")).alias("quotes"))
    own = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each split of a file
    parity = lines.groupBy("file", "split").agg(F.sum("quotes").alias("n")).select(
        "file", "split", (F.coalesce(F.sum("n").over(own), F.lit(0)) % 2).cast("int").alias("odd"))
    placed = materialise(lines.join(parity, ["file", "split"]).mapInArrow(_record_lines, _LINE_SCHEMA), "csv-lines")
    whole = placed.where("kind = 'record' and value <> ''").select(F.col("value").alias("record"))
    # lines in front of a split's first record go to the last record that began before it
    begun = placed.where("kind = 'split'").select("file", "split", F.when(F.col("record") > 0, F.struct("split", "record")).alias("last"))
    home = begun.select("file", "split", F.last("last", ignorenulls=True).over(own).alias("home"))
    parts = placed.where("kind = 'line'").join(home, ["file", "split"]).select(
        "file", F.when(F.col("record") == 0, F.col("home")).otherwise(F.struct("split", "record")).alias("home"), "split", "line", "value")
    joined = parts.groupBy("file", "home").agg(F.array_sort(F.collect_list(F.struct("split", "line", "value"))).alias("lines"))
    return whole.unionByName(joined.select(F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("record")))


_LINE_SCHEMA = "kind string, file string, split long, record long, line long, value string"


def _record_lines(batches):
    """Lines with the number of the record, within their split, that they belong to (0: one that began before the split);
    kind 'record' where a line is a whole record. One row of kind 'split' has the number of records that began in it."""
    import numpy as np
    import pyarrow as pa

    state = {}  # of the split that is being read: quotes in front, records begun, lines
    names = ["kind", "file", "split", "record", "line", "value"]

    def closed(key):
        return pa.RecordBatch.from_arrays([pa.array(["split"]), pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([state[key][1]], pa.int64()),
                                           pa.array([0], pa.int64()), pa.nulls(1, pa.string())], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        files, splits = batch.column("file").to_pylist(), batch.column("split").to_numpy()
        quotes, odd = batch.column("quotes").to_numpy(), batch.column("odd").to_numpy()
        edges = [0, *(i for i in range(1, len(files)) if (files[i], splits[i]) != (files[i - 1], splits[i - 1])), len(files)]
        for lo, hi in zip(edges, edges[1:]):
            key = (files[lo], int(splits[lo]))
            if key not in state:
                for old in list(state):
                    yield closed(old)
                    del state[old]
                state[key] = (int(odd[lo]), 0, 0)
            before, begun, line = state[key]
            q = quotes[lo:hi]
            ahead = before + np.cumsum(q) - q
            starts = ahead % 2 == 0
            record = begun + np.cumsum(starts)
            state[key] = (int(before + q.sum()), int(record[-1]), line + hi - lo)
            kind = np.where(starts & (q % 2 == 0), "record", "line")
            yield pa.RecordBatch.from_arrays([pa.array(kind.tolist(), pa.string()), batch.column("file").slice(lo, hi - lo), batch.column("split").slice(lo, hi - lo),
                                              pa.array(record, pa.int64()), pa.array(np.arange(line, line + hi - lo)), batch.column("value").slice(lo, hi - lo)], names)
    for old in list(state):
        yield closed(old)


def scan_class_files(spark: SparkSession, files: dict[str, str], encoding: str = "ISO-8859-1",
                     encodings: dict[str, str] | None = None) -> DataFrame:
    """One sentence per line, label from the file.

    Output (text, label, src_order): ``src_order`` sorts by file order and line
    order, also within a folder of files, so a later duplicate can win (W7).
    """
    parts = []
    for i, (path, label) in enumerate(files.items()):
        enc = (encodings or {}).get(path, encoding)
        df = spark.read.text(path).select(_decode(F.col("value"), enc).alias("text"), F.lit(label).alias("label"),
                                          _line_order(F.lit(i).alias("file_no")).alias("src_order"))
        parts.append(df)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scan_lexicon(spark: SparkSession, files: dict[str, int], comment: str = ";",
                 include_comments: bool = False, pattern: str = r"[a-z\-]+") -> DataFrame:
    """Polarity word lists -> (word, polarity); a later file overrides an
    earlier one (S6). Comment lines are skipped unless ``include_comments``,
    which reproduces scanning the whole file for words."""
    parts = []
    for i, (path, pol) in enumerate(files.items()):
        lines = spark.read.text(path)
        if not include_comments:
            lines = lines.where(~F.startswith(F.col("value"), F.lit(comment)))
        parts.append(lines.select(F.explode(F.regexp_extract_all("value", F.lit(pattern), 0)).alias("word"),
                                  F.lit(pol).cast("int").alias("polarity"), F.lit(i).alias("file_no")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return lexicon_last_wins(out)


def lexicon_last_wins(words: DataFrame) -> DataFrame:
    """(word, polarity) keeping the entry of the highest ``file_no``."""
    best = words.groupBy("word").agg(F.max_by("polarity", "file_no").alias("polarity"))
    return best


def scan_pairs(spark: SparkSession, path: str | Sequence[str], names: tuple[str, str] = ("qid", "docid")) -> DataFrame:
    """Whitespace pair file (S7): blank and ``#`` lines skipped, ids cast to
    bigint (``01`` is 1), any other arity fails the job. ``line_no`` sorts by file
    name and line, which is the rank order of a run, be it a file or a folder."""
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    lines = lines.select("value", _line_order().alias("line_no"))
    kept = lines.where(~F.col("value").rlike(r"^\s*($|#)"))
    toks = F.split(F.trim(F.col("value")), r"\s+")
    checked = kept.select(
        F.when(F.size(toks) == 2, toks).otherwise(
            F.raise_error(F.concat(F.lit("bad line in pair file: <"), F.col("value"), F.lit(">")))
        ).alias("t"), "line_no")
    return checked.select(F.col("t")[0].cast("bigint").alias(names[0]),
                          F.col("t")[1].cast("bigint").alias(names[1]), "line_no")


def scan_embeddings(spark: SparkSession, path: str, vocab: DataFrame, dim: int,
                    word_col: str = "word") -> DataFrame:
    """Text rows ``word f1 .. fdim`` -> (word, vector) for each vocabulary word
    (S9). Repeated words are summed; vocabulary words without a row get the
    zero vector."""
    parts = F.split(F.trim(F.col("value")), " ")
    raw = spark.read.text(path).select(parts[0].alias(word_col), F.transform(F.slice(parts, 2, dim), lambda x: x.cast("double")).alias("x"))
    known = raw.join(vocab.select(word_col), word_col, "left_semi")
    # one row a word: sums of the places, not a row for each word and place
    vec = known.groupBy(word_col).agg(*(F.sum(F.get("x", F.lit(i))).alias(f"_x{i}") for i in range(dim))).select(
        word_col, F.array(*(F.coalesce(f"_x{i}", F.lit(0.0)).cast("float") for i in range(dim))).alias("vector"))
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return (vocab.select(word_col).join(vec, word_col, "left")
            .select(word_col, F.coalesce(F.col("vector"), zero).alias("vector")))


def scan_images_as_vectors(df: DataFrame, features: str = "embedding", label: str = "label") -> DataFrame:
    """Flattened images stored as array<float> -> ML vector column."""
    from pyspark.ml.functions import array_to_vector

    return df.select(array_to_vector(F.col(features)).alias("features"), F.col(label).alias("label"),
                     *[c for c in df.columns if c not in (features, label)])


def write_ranked_run(ranked: DataFrame, path: str, qid: str = "qid", docid: str = "docid",
                     rank: str = "rank") -> None:
    """Write ``qid docid`` lines, queries ascending, rank order within.
    The range-partitioned sort writes files whose name order is line order."""
    (ranked.orderBy(qid, rank).select(F.concat_ws(" ", F.col(qid), F.col(docid)).alias("value"))
     .write.mode("overwrite").text(path))


def report_table(parts: dict[str, DataFrame]) -> DataFrame:
    """Stack small result tables under a ``section`` tag."""
    out = None
    for tag, df in parts.items():
        d = df.select(F.lit(tag).alias("section"), *df.columns)
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def cached_scan(df: DataFrame) -> DataFrame:
    """Persist a scan reused by several queries (S13); spills to disk rather
    than recomputing. The scope it is made in (``session.reuse``) releases it."""
    return persist(df)


def dedup_last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keep the last row (highest ``order``) of each ``key``.

    ``max_by`` is a partial aggregate: each task keeps one row per key before
    the shuffle, so a key repeated millions of times costs one row of traffic.
    """
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in rest])
