"""Speech-corpus tables derived from the general tables, once in Spark and once as SQL.

A clip is a sentence or line of a document; its units are the longest-match tokens of it. Durations are whole
milliseconds, so that no float sum decides a boundary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtable.functions.units import tokenize

SYMBOLS = ["th", "sh", "ch", "ou", "er", "in", *"abcdefghijklmnopqrstuvwxyz", ",", "."]
UNIT_PATTERN = "th|sh|ch|ou|er|in|[a-z,.]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """A table of a few files, fewer than there are cores, is dealt out over the cores; a large one stays as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lines = docs.select("doc_id", "lang", "source", F.posexplode(F.split(F.replace(F.coalesce("text", F.lit("")), F.lit(". "), F.lit(".\n")), "\n")).alias("line_no", "text"))
    units = tokenize(F.lower("text"), SYMBOLS)
    at = F.col("doc_id") + F.col("line_no")
    rows = lines.withColumn("ipa_units", units).withColumn("n_units", F.size("ipa_units"))
    ms = F.when(at % 29 == 0, F.lit(200)).when(at % 31 == 0, F.lit(30000)).otherwise(F.floor(F.col("n_units") * 1000 / (4 + at % 10)))
    shard = F.concat(F.when(F.col("doc_id") % 10 == 0, "test-").otherwise("train-"), "source", F.format_string("-%05d", F.floor(F.col("doc_id") / 1000)))
    return rows.select(
        F.format_string("segment_%06d_%04d", "doc_id", "line_no").alias("id"), F.format_string("segment_%06d", "doc_id").alias("recording"), "doc_id", F.col("line_no").cast("long").alias("line_no"),
        shard.alias("shard"), F.col("lang").alias("language"), "text", "ipa_units", F.array_join("ipa_units", " ").alias("ipa"), F.col("n_units").cast("long").alias("n_units"),
        ms.cast("long").alias("dur_ms"), (ms.cast("long") / 1000.0).alias("duration"),
    )


CLIPS = f"""
    doc_lines as (
        select doc_id, lang, source, unnest(parts) as text, unnest(range(len(parts))) as line_no
        from (select *, string_split(replace(coalesce(text, ''), '. ', '.' || chr(10)), chr(10)) as parts from documents)),
    doc_units as (select *, regexp_extract_all(lower(text), '{UNIT_PATTERN}') as u, doc_id + line_no as k from doc_lines),
    clips0 as (
        select printf('segment_%06d_%04d', doc_id, line_no) as id, printf('segment_%06d', doc_id) as recording, doc_id, line_no::bigint as line_no,
            case when doc_id % 10 = 0 then 'test-' else 'train-' end || source || printf('-%05d', doc_id // 1000) as shard, lang as language, text, u as ipa_units,
            array_to_string(u, ' ') as ipa, len(u)::bigint as n_units,
            (case when k % 29 = 0 then 200 when k % 31 = 0 then 30000 else len(u) * 1000 // (4 + k % 10) end)::bigint as dur_ms
        from doc_units),
    clips as (select *, dur_ms / 1000.0::double as duration, case when doc_id % 10 = 0 then 'test' else 'train' end as split from clips0)"""


def speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id (of a recording), speaker, speaker_idx and recording metrics."""
    v = F.col("vec_id")
    index = F.col("label") * 10 + v % 10
    return table(spark, sf_dir, "embeddings").select(
        F.format_string("segment_%06d", v).alias("id"), F.format_string("spk_%04d", index).alias("speaker"), index.cast("long").alias("speaker_idx"),
        (v * 37 % 400 / 10.0).alias("snr_est"), (v % 13 / 10000.0).alias("clip_frac"), (v % 17 / 20.0).alias("silence_frac"),
    )


SPEAKERS = """
    speakers as (
        select printf('segment_%06d', vec_id) as id, printf('spk_%04d', (label * 10 + vec_id % 10)::bigint) as speaker, (label * 10 + vec_id % 10)::bigint as speaker_idx,
            vec_id * 37 % 400 / 10.0::double as snr_est, vec_id % 13 / 10000.0::double as clip_frac, vec_id % 17 / 20.0::double as silence_frac
        from embeddings)"""


def spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips keyed by recording, as side tables are: id is the recording."""
    return clips(spark, sf_dir).withColumnsRenamed({"id": "clip", "recording": "id"})


def hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, language, doc_id, ref, hyp: a recogniser that drops every eleventh unit or so and mistakes the first of every fifth document."""
    rows = clips(spark, sf_dir)
    kept = F.filter("ipa_units", lambda u, i: (i * 7 + F.col("doc_id")) % 11 != 0)
    wrong = F.when((F.col("doc_id") % 5 == 0) & (F.size(kept) > 0), F.concat(F.array(F.lit("x")), F.slice(kept, F.lit(2), F.size(kept)))).otherwise(kept)
    return rows.select("id", "language", "doc_id", "shard", F.col("ipa_units").alias("ref"), wrong.alias("hyp"))


HYPOTHESES = f"""{CLIPS},
    kept as (select *, list_filter(ipa_units, lambda u, i: ((i - 1) * 7 + doc_id) % 11 <> 0) as h0 from clips),
    hyps as (select id, language, doc_id, shard, ipa_units as ref, case when doc_id % 5 = 0 and len(h0) > 0 then list_concat(['x'], h0[2:]) else h0 end as hyp from kept),
    coded as (
        select *, array_to_string(list_transform(ref, lambda x: case x when 'th' then 'T' when 'sh' then 'S' when 'ch' then 'C' when 'ou' then 'O' when 'er' then 'E' when 'in' then 'I' else x end), '') as r,
            array_to_string(list_transform(hyp, lambda x: case x when 'th' then 'T' when 'sh' then 'S' when 'ch' then 'C' when 'ou' then 'O' when 'er' then 'E' when 'in' then 'I' else x end), '') as h
        from hyps)"""


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, phones: a part of the corpus' words, spelled as phones; vowels carry a stress digit."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z']+"), F.lit(0)))).alias("word"))
    known = words.distinct().filter(F.substring(F.md5("word"), 1, 1) < "c")
    return known.select("word", F.transform(F.split("word", ""), lambda c: F.when(c.isin(*"aeiou"), "AH1").otherwise(F.upper(c))).alias("phones"))


LEXICON = """
    words0 as (select distinct unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z'']+')) as word from documents),
    lexicon as (select word, list_transform(string_split(word, ''), lambda c: case when c in ('a', 'e', 'i', 'o', 'u') then 'AH1' else upper(c) end) as phones
        from words0 where substr(md5(word), 1, 1) < 'c')"""


def agreement_sql() -> str:
    phone = "case p when 'AH1' then 'V' when 'Y' then 'j' when 'P' then 'p' when 'B' then 'b' when 'T' then 't' when 'D' then 'd' when 'K' then 'k' when 'G' then 'g' when 'F' then 'f' when 'V' then 'v' when 'S' then 's' when 'Z' then 'z' when 'M' then 'm' when 'N' then 'n' when 'L' then 'l' when 'R' then 'r' when 'W' then 'w' else null end"
    unit = "case u when 'a' then 'V' when 'e' then 'V' when 'i' then 'V' when 'o' then 'V' when 'u' then 'V' when 'ou' then 'V' when 'x' then 'h' when 'h' then 'h' when 'j' then 'j' when 'p' then 'p' when 'b' then 'b' when 't' then 't' when 'd' then 'd' when 'k' then 'k' when 'g' then 'g' when 'f' then 'f' when 'v' then 'v' when 's' then 's' when 'z' then 'z' when 'm' then 'm' when 'n' then 'n' when 'l' then 'l' when 'r' then 'r' when 'w' then 'w' else null end"
    return f"""{CLIPS},{LEXICON},
    spelled as (select id, unnest(regexp_extract_all(lower(text), '[a-z'']+')) as word, unnest(range(len(regexp_extract_all(lower(text), '[a-z'']+')))) as at_ from clips),
    looked as (select s.id, at_, phones from spelled s left join lexicon l on s.word = l.word),
    found as (select id, count(*) as n_words, count(phones) as n_known, flatten(list(phones order by at_) filter (where phones is not null)) as phones from looked group by id),
    classes as (
        select clips.*, coalesce(n_known::double / n_words, 0.0) as coverage,
            list_filter(list_transform(coalesce(phones, []), lambda p: {phone}), lambda p: p is not null) as e0,
            list_filter(list_transform(ipa_units, lambda u: {unit}), lambda u: u is not null) as o0
        from clips left join found using (id)),
    collapsed as (
        select *, array_to_string(list_filter(e0, lambda x, i: i = 1 or x <> e0[i - 1]), '') as e, array_to_string(list_filter(o0, lambda x, i: i = 1 or x <> o0[i - 1]), '') as o
        from classes),
    agreed as (select * exclude (e0, o0), case when length(e) = 0 then 1.0::double else levenshtein(e, o)::double / length(e) end as uer from collapsed)"""
