"""Manifest TSV (header, tabs, no quoting, backslash escapes, CRLF row ends) and training metadata lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtable.functions.clips import sanitize_text

FIELDS = ("id", "speaker", "split", "duration", "text", "ipa", "n_units", "language")
_TYPES = {"duration": "double", "n_units": "int"}


def escaped(value: Column) -> Column:
    r"""Backslash before each backslash, tab, double quote, CR and LF."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), '([\\\\\t"\r\n])', "\\\\$1")


def unescaped(value: Column) -> Column:
    """A field without the backslash before each escaped character."""
    return F.regexp_replace(value, r"\\([\s\S])", "$1")


def fields_of(line: Column) -> Column:
    r"""Fields of one record. A field is what follows a tab, up to the next one without a backslash; a lone backslash at the end says nothing."""
    found = F.regexp_extract_all(F.concat(F.lit("\t"), line), F.lit(r"\t((?:[^\\\t]|\\[\s\S])*+)"), F.lit(1))
    return F.transform(found, unescaped)


def manifest_lines(df: DataFrame, fields=FIELDS) -> DataFrame:
    """One column, line; missing columns are empty."""
    return df.select(_line(df, fields).alias("line"))


def _line(df: DataFrame, fields) -> Column:
    return F.concat_ws("\t", *[escaped(F.col(c)) if c in df.columns else F.lit("") for c in fields])


def parse_lines(lines: DataFrame, fields=FIELDS) -> DataFrame:
    """Typed columns of records (column line), without the header; numbers that don't parse are null."""
    cells = lines.filter(F.col("line") != "\t".join(fields)).withColumn("cells", fields_of(F.col("line")))
    return cells.select(*[(F.get("cells", F.lit(k)).try_cast(_TYPES[c]) if c in _TYPES else F.get("cells", F.lit(k))).alias(c) for k, c in enumerate(fields)], *[c for c in ("line_no",) if c in lines.columns])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    r"""Columns of the header, typed. Records end in CRLF; an embedded CRLF was written as ``\CR\LF``, so it doesn't end one."""
    text = spark.read.option("lineSep", "\r\n").text(path)
    files = text.select(F.col("_metadata.file_path").alias("file"))
    first = files.agg(F.min("file")).first()[0]
    header = spark.read.option("lineSep", "\r\n").text(first).first() if first else None
    # of many files, rows are in order by file, block and place
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    return parse_lines(text.select(F.col("value").alias("line"), place.alias("line_no")), tuple(header["value"].split("\t")) if header else FIELDS)


#: Rows of a manifest that is written as one file.
SINGLE_ROWS = 1_000_000


def write_manifest(df: DataFrame, path: str, fields=FIELDS, order: str = "id", single: bool = False) -> None:
    """Files that are in order one after the other, the header in the first; ``single`` writes one file, for manifests of SINGLE_ROWS rows at most."""
    if single and df.limit(SINGLE_ROWS + 1).count() > SINGLE_ROWS:
        raise ValueError(f"over {SINGLE_ROWS} rows are too many for one file")
    kind = df.schema[order].dataType
    header = df.sparkSession.range(1).select(F.lit("\t".join(fields)).alias("line"), F.lit(0).alias("part"), F.lit(None).cast(kind).alias("key"))
    out = header.unionByName(df.select(_line(df, fields).alias("line"), F.lit(1).alias("part"), F.col(order).alias("key")))
    out = out.repartitionByRange(1, "part", "key") if single else out.repartitionByRange("part", "key")
    out.sortWithinPartitions("part", "key").select("line").write.option("lineSep", "\r\n").text(path)


def val_manifest(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "test")


def training_lines(df: DataFrame) -> DataFrame:
    """id, speaker, split, text, ids (array<int>) -> line and set (test -> val); rows of other splits and rows without ids are left out."""
    kept = df.filter(F.col("ids").isNotNull() & F.col("split").isin("train", "test"))
    line = F.concat_ws("|", F.concat("id", F.lit(".wav")), F.coalesce("speaker", F.lit("")), sanitize_text(F.col("text")), F.concat_ws(" ", F.transform("ids", lambda x: x.cast("string"))))
    return kept.select("id", F.when(F.col("split") == "test", "val").otherwise("train").alias("set"), line.alias("line"))


def write_training_metadata(df: DataFrame, path: str) -> None:
    training_lines(df).select("set", "line").write.partitionBy("set").text(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """symbol, id from lines ``symbol id``; blank lines are skipped."""
    return parse_tokens(spark.read.text(path).select(F.col("value").alias("line")))


def parse_tokens(lines: DataFrame) -> DataFrame:
    rows = lines.filter(F.col("line") != "")
    return rows.select(F.regexp_extract("line", r"^(.*) (\d+)$", 1).alias("symbol"), F.regexp_extract("line", r"^(.*) (\d+)$", 2).try_cast("int").alias("id"))


def real_units(tokens: DataFrame) -> DataFrame:
    return tokens.filter(~(F.startswith("symbol", F.lit("<")) & F.endswith("symbol", F.lit(">"))))


def parse_symbol_map(text: Column) -> Column:
    """JSON map symbol -> ids, bare or under phoneme_id_map."""
    kind = "map<string,array<int>>"
    nested = F.from_json(text, f"phoneme_id_map {kind}")["phoneme_id_map"]
    return F.coalesce(nested, F.from_json(text, kind))


def read_symbol_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("wholetext", True).text(path).select(F.explode(parse_symbol_map(F.col("value"))).alias("symbol", "ids"))


def sentences_of(text: Column) -> Column:
    """Lines, trimmed, blanks dropped; numbered after dropping by posexplode."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != "")


def read_sentences(spark: SparkSession, path: str, lang: str) -> DataFrame:
    return spark.read.option("wholetext", True).text(path).select(F.lit(lang).alias("lang"), F.posexplode(sentences_of(F.col("value"))).alias("number", "text"))
