"""Registered queries that go through a writer, a stream or a plug: what was written is read back, and stand-in models have DuckDB twins."""

from __future__ import annotations

import io
import uuid
import wave

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxtable.functions import clips, units
from voxtable.operators import assemble, plugs, quality
from voxtable.plans import views as v
from voxtable.plans.queries import _FLAGGED, BASE, MIN_CLIPS, query
from voxtable.sources import corpus, files, wavs
from voxtable.streaming import ingest


def _folder(spark: SparkSession, name: str) -> str:
    return f"{corpus.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- writers -------------------------------------------------------------------------------------------------------


@query(f"with {v.CLIPS} select shard, count(*)::bigint as clips, sum(n_units)::bigint as n_units, min(id) as first_id, max(id) as last_id from clips group by shard")
def write_results(spark, d):
    path = _folder(spark, "results")
    corpus.write_results(v.clips(spark, d).select("id", "shard", "n_units"), path)
    return spark.read.parquet(path).groupBy("shard").agg(F.count("*").alias("clips"), F.sum("n_units").alias("n_units"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query(f"""with {v.CLIPS}, ranked as (select id, n_units, split, row_number() over (partition by split order by id) - 1 as r, count(*) over (partition by split) as n from clips)
    select printf('%s-%05d-of-%05d.parquet', split, (r // 1000)::bigint, ((n + 999) // 1000)::bigint) as file_name, count(*)::bigint as clips, sum(n_units)::bigint as n_units,
        min(id) as first_id, max(id) as last_id from ranked group by file_name""")
def write_sidecar(spark, d):
    path = _folder(spark, "sidecar")
    corpus.write_sidecar(v.clips(spark, d).select("id", "shard", "n_units"), path, 1000)
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("clips"), F.sum("n_units").alias("n_units"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


_STATS = """s as (select split, count(*)::bigint as clips, round(sum(dur_ms) / 3600000.0::double, 2) as hours, sum(n_units)::bigint as phoneme_units,
        round(sum(n_units) / count(*)::double, 1) as mean_units_per_clip from clips group by split)"""


@query(f"with {v.CLIPS},{_STATS} select split, clips, hours, phoneme_units, mean_units_per_clip from s")
def write_stats(spark, d):
    path = _folder(spark, "stats")
    corpus.write_stats(assemble.corpus_stats(v.clips(spark, d)), path)
    return spark.read.json(path).select("split", "clips", "hours", "phoneme_units", "mean_units_per_clip")


@query(f"""with {v.CLIPS},{_STATS} select format('| `{{}}` | {{:,}} | {{:,}} | {{:,}} | {{}} |', split, clips, hours, phoneme_units, mean_units_per_clip) as line from s""")
def stats_markdown(spark, d):
    """The table's rows, one a split."""
    lines = corpus.stats_markdown(assemble.corpus_stats(v.clips(spark, d))).split("\n")[2:]
    return spark.createDataFrame([(x,) for x in lines], "line string")


@query("select doc_id, strlen(coalesce(text, ''))::bigint as n_bytes, null::varchar as path, md5(coalesce(text, '')) as digest from documents")
def normalize_audio(spark, d):
    """Bare bytes, as an older shard has them, as the struct of the newer ones."""
    rows = v.table(spark, d, "documents").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("audio"))
    return corpus.normalize_audio(rows).select("doc_id", F.octet_length("audio.bytes").cast("long").alias("n_bytes"), "audio.path", F.md5("audio.bytes").alias("digest"))


# ---- shards as files -------------------------------------------------------------------------------------------------


def _shard_files(spark: SparkSession, d: str) -> str:
    """A folder with a file a shard: its clips by id, with audio (the text's bytes stand for it)."""
    path = _folder(spark, "shards")
    audio = F.struct(F.encode("text", "UTF-8").alias("bytes"), F.col("id").alias("path")).alias("audio")
    files.write_named(v.clips(spark, d).select("id", audio, F.concat("shard", F.lit(".parquet")).alias("file_name")), path, order=("id",))
    return path


_IN_FILES = f"{v.CLIPS}, placed as (select *, shard || '.parquet' as file, row_number() over (partition by shard order by id) - 1 as row_ from clips)"


@query(f"with {_IN_FILES} select id, file as shard, row_::bigint as \"row\", ipa, n_units, md5(text) as audio_md5 from placed")
def attach_audio_files(spark, d):
    """Audio beside its metadata, which comes in rounds of 4 MiB, each to the files of its own shards; paths and counts are checked before."""
    source = corpus.read_shards(spark, _shard_files(spark, d), ["audio"])
    rows = v.clips(spark, d).withColumn("shard", F.concat("shard", F.lit(".parquet"))).withColumn("row", F.row_number().over(W.partitionBy("shard").orderBy("id")).cast("long") - 1)
    out = assemble.attach_audio(rows.select("id", "shard", "row", F.col("id").alias("audio_path"), "ipa", "n_units"), source, most=4 << 20)
    return out.select("id", "shard", "row", "ipa", "n_units", F.md5(F.col("audio.bytes")).alias("audio_md5"))


@query(f"with {_IN_FILES} select id, file as shard, row_::bigint as \"row\", dur_ms, md5(text) as audio_md5 from placed where n_units % 3 = 0")
def join_selected_files(spark, d):
    """Source rows of chosen clips: ids are brought to the rows' addresses, then to the tasks that read the audio."""
    source = corpus.read_shards(spark, _shard_files(spark, d))
    chosen = v.clips(spark, d).select("id", "dur_ms", (F.col("n_units") % 3 == 0).alias("selected"))
    return assemble.join_selected(source, chosen, most=4 << 20).select("id", "shard", "row", "dur_ms", F.md5(F.col("audio.bytes")).alias("audio_md5"))


@query(f"with {_IN_FILES} select file as shard, count(*)::bigint as clips, max(row_)::bigint as last_row, min(id) as first_id from placed where file not like 'test-%' group by file")
def read_pending(spark, d):
    """The shards whose results aren't there: those of the test split are."""
    source, results = _shard_files(spark, d), _folder(spark, "results")
    done = v.clips(spark, d).filter(F.col("shard").like("test-%")).select("id", F.concat("shard", F.lit(".parquet")).alias("file_name"))
    files.write_named(done, results)
    return files.read_pending(spark, source, results, columns=["id"]).groupBy("shard").agg(F.count("*").alias("clips"), F.max("row").alias("last_row"), F.min("id").alias("first_id"))


@query(f"""with {_IN_FILES}, s as (select distinct file from placed where contains(file, 'src1') and file not like 'test-%' order by file limit 3)
    select file as shard, count(*)::bigint as clips from placed where file in (select file from s) group by file""")
def read_pending_some(spark, d):
    """Of the pending shards of some name the first three."""
    source, results = _shard_files(spark, d), _folder(spark, "results")
    done = v.clips(spark, d).filter(F.col("shard").like("test-%")).select("id", F.concat("shard", F.lit(".parquet")).alias("file_name"))
    files.write_named(done, results)
    return files.read_pending(spark, source, results, "src1", 3, ["id"]).groupBy("shard").agg(F.count("*").alias("clips"))


# ---- streaming -----------------------------------------------------------------------------------------------------


@query(f"""with {v.CLIPS} select id, concat_ws(',', case when n_units = 0 then 'no_phonemes' end, case when duration < 0.4::double then 'too_short' end, case when duration > 20.0::double then 'too_long' end,
        case when n_units / greatest(duration, 0.001::double) < 4 or n_units / greatest(duration, 0.001::double) > 25 then 'bad_rate' end,
        case when length(text) > 0 and n_units / length(text) < 0.35::double then 'short_vs_text' end) as qc_reason from clips""")
def ingested(spark, d):
    """The clips come in two lots; after each a run takes the files that are new. A third run finds none."""
    source, target, seen = (_folder(spark, x) for x in ("arrived", "ingested", "progress"))
    schema = "id string, text string, n_units long, duration double"
    rows = v.clips(spark, d).select("id", "text", "n_units", "duration", clips.split_of(F.col("shard")).alias("split"))
    for split in ("train", "test"):
        rows.filter(F.col("split") == split).drop("split").write.mode("append").parquet(source)
        ingest.ingest(spark, source, schema, target, seen).awaitTermination()
    ingest.ingest(spark, source, schema, target, seen).awaitTermination()
    return spark.read.parquet(target).select("id", "qc_reason")


@query(f"{_FLAGGED} select id, speaker, rare_speaker, qc_reason from flagged")
def ingested_speakers(spark, d):
    """Each lot of clips meets the speaker table as it streams in."""
    source, target, seen = (_folder(spark, x) for x in ("arrived", "ingested", "progress"))
    side = v.speakers(spark, d).select(F.col("id").alias("recording"), "speaker").join(quality.speaker_counts(v.speakers(spark, d), MIN_CLIPS), "speaker")
    rows = v.clips(spark, d)
    of_clips = rows.select("id", "recording").join(side, "recording").select("id", "speaker", "small")
    schema = "id string, text string, n_units long, duration double"
    for split in ("train", "test"):
        rows.filter(clips.split_of(F.col("shard")) == split).select("id", "text", "n_units", "duration").write.mode("append").parquet(source)
        ingest.ingest(spark, source, schema, target, seen, of_clips, quality.QcLimits(min_speaker_clips=MIN_CLIPS)).awaitTermination()
    return spark.read.parquet(target).select("id", "speaker", "rare_speaker", "qc_reason")


# ---- waves and plugs -----------------------------------------------------------------------------------------------


def _pcm(of: str) -> str:
    """SQL: the samples of a clip as 16-bit integers, scaled down as a whole if they peak over 1."""
    return f"""w as (select printf('segment_%06d', vec_id) as id, list_transform(embedding, lambda x: (x * 5)::float) as s from embeddings),
    peaks as (select id, s, list_max(list_transform(s, lambda x: abs(x)))::float as peak from w),
    {of} as (select id, list_transform(s, lambda x: round_even((case when peak > 1 then x / peak else x end)::float::double * 32767, 0)::bigint) as q from peaks)"""


def _waves(spark: SparkSession, d: str, samples: Column | None = None) -> DataFrame:
    values = F.transform("embedding", lambda x: (x * 5).cast("float"))
    rows = v.table(spark, d, "embeddings").select(F.format_string("segment_%06d", "vec_id").alias("id"), values.alias("samples"), F.lit(400).alias("rate"))
    return rows if samples is None else rows.withColumn("samples", samples)


def _stereo_header(samples: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(2)
        f.setsampwidth(2)
        f.setframerate(400)
        f.writeframes(bytes(4 * samples))
    return out.getvalue()[:44]


@query("""with w as (select printf('segment_%06d', vec_id) as id, list_transform(embedding, lambda x: round_even((x * 5)::float::double * 3000, 0)::bigint) as q from embeddings)
    select id, len(q) // 2 as n, list_sum(q)::bigint as total, list_sum(list_transform(range(0, len(q) // 2), lambda k: (q[2 * k + 1] + q[2 * k + 2]) * (k + 1)))::bigint as weighted from w""")
def mono_mix(spark, d):
    """Two-channel wav bytes, decoded to one channel; sums over twice the mixed samples, plain and weighted by place."""
    whole = F.transform("samples", lambda x: F.rint(x.cast("double") * 3000).cast("int"))
    byte = lambda x, by: F.lpad(F.hex(F.shiftright(x, by).bitwiseAND(255)), 2, "0")
    body = F.array_join(F.transform("whole", lambda x: F.concat(byte(x, 0), byte(x, 8))), "")
    rows = _waves(spark, d).withColumn("whole", whole)
    out = wavs.decode(rows.select("id", F.unhex(F.concat(F.lit(_stereo_header(32).hex()), body)).alias("wav")), "wav")
    twice = F.transform("samples", lambda x: F.round(x.cast("double") * 65536).cast("long"))
    add = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + x)
    return out.select("id", F.size("samples").cast("long").alias("n"), add(twice).alias("total"), add(F.transform(twice, lambda x, k: x * (k + 1))).alias("weighted"))


def _loudness():
    """A stand-in recogniser: each frame is above, below or about its wave's mean, in deviations of the normalised wave."""

    def model(block: np.ndarray, sizes: np.ndarray, rate: int) -> np.ndarray:
        frames = block[:, : block.shape[1] // plugs.DOWNSAMPLE * plugs.DOWNSAMPLE].reshape(len(block), -1, plugs.DOWNSAMPLE).mean(axis=2, dtype=np.float64)
        return np.where(frames > 0.1, 1, np.where(frames < -0.1, 2, 0))

    return model


@query(f"""with {_pcm("i")},
    m as (select id, list_transform(q[1:48], lambda x: x / 32768.0::double) as x from i),
    z as (select id, list_avg(x) as mean, list_avg(list_transform(x, lambda y: y * y)) - list_avg(x) ** 2 as var, list_transform(range(0, 3), lambda k: list_avg(x[k * 16 + 1:k * 16 + 16])) as f from m),
    c as (select id, list_transform(f, lambda y: case when (y - mean) / sqrt(var + 1e-5) > 0.1 then 'up' when (y - mean) / sqrt(var + 1e-5) < -0.1 then 'down' else '-' end) as c from z),
    u as (select id, list_filter(list_filter(c, lambda x, k: k = 1 or x <> c[k - 1]), lambda x: x <> '-') as u from c)
    select id, 3.2::double as duration, array_to_string(u, ' ') as ipa, len(u)::bigint as n_units from u""")
def transcribed(spark, d):
    """From wav bytes to units: each sample held for 20, cut at 2.4 of the 3.2 seconds, normalised, batched, collapsed."""
    held = F.flatten(F.transform("samples", lambda x: F.array_repeat(x, 20)))
    data = wavs.as_wav(_waves(spark, d, held), 400).select("id", F.col("wav").alias("bytes"))
    out = plugs.transcribe(data, _loudness, ["-", "up", "down"], target=400, max_seconds=2.4, budget=200_000)
    return out.select("id", F.round(F.col("duration").cast("double"), 3).alias("duration"), "ipa", F.col("n_units").cast("long").alias("n_units"))


def _profile():
    """A stand-in embedder: mean size, least and greatest of a wave."""
    return lambda waves, rate: np.array([[np.abs(x.astype(np.float64)).mean(), x.min(), x.max()] for x in waves])


@query("""with w as (select printf('segment_%06d', vec_id) as id, list_transform(embedding[1:40], lambda x: (x * 5)::float::double) as s from embeddings),
    p as (select id, [list_avg(list_transform(s, lambda x: abs(x))), list_min(s), list_max(s)] as p from w),
    n as (select id, p, sqrt(p[1] * p[1] + p[2] * p[2] + p[3] * p[3]) + 1e-9 as n from p)
    select id, round((p[1] / n)::float::double, 5) as mean_size, round((p[2] / n)::float::double, 5) as least, round((p[3] / n)::float::double, 5) as greatest from n""")
def embedded(spark, d):
    """Embeddings of the first tenth of a second, of unit length."""
    out = plugs.embed(_waves(spark, d), _profile, 0.1)
    return out.select("id", *(F.round(F.col("embedding")[k].cast("double"), 5).alias(c) for k, c in enumerate(("mean_size", "least", "greatest"))))


def _profile_of_rows():
    """The same of the rows of a padded matrix, by their relative lengths; a batch is of one rate, of four rows at most, and none is much shorter than another if it is full."""

    def model(block: np.ndarray, lengths: np.ndarray, rate: int) -> np.ndarray:
        sizes = np.rint(lengths * block.shape[1]).astype(int)
        if rate not in (400, 800) or len(block) > 4 or sizes.max() != block.shape[1] or (len(block) == 4 and sizes.min() < 1):
            raise ValueError("not a batch")
        return np.array([[np.abs(x[:n].astype(np.float64)).mean(), x[:n].min(), x[:n].max()] for x, n in zip(block, sizes, strict=True)])

    return model


@query(f"""with {_pcm("i")},
    c as (select id, substr(id, 9)::bigint as k, list_transform(q, lambda x: x / 32768.0::double) as x from i),
    s as (select id, k, x[1:16 + (k % 4)::bigint * 16] as x from c),
    m as (select id, k, x[1:40] as y, list_sort(list_transform(range(0, len(x) // 8), lambda j: list_sum(list_transform(x[j * 8 + 1:j * 8 + 8], lambda v: v * v)) / 8 + 1e-12)) as e from s),
    p as (select *, 0.1::double * (len(e) - 1) as a, 0.9::double * (len(e) - 1) as b from m),
    r as (select *, e[floor(a)::bigint + 1] + (a - floor(a)) * (e[ceil(a)::bigint + 1] - e[floor(a)::bigint + 1]) as low, e[floor(b)::bigint + 1] + (b - floor(b)) * (e[ceil(b)::bigint + 1] - e[floor(b)::bigint + 1]) as high from p),
    v as (select *, [list_avg(list_transform(y, lambda x: abs(x))), list_min(y), list_max(y)] as v from r),
    n as (select *, sqrt(v[1] * v[1] + v[2] * v[2] + v[3] * v[3]) + 1e-9 as n from v)
    select id, case when k % 7 = 0 then 'EOFError' end as failed, case when k % 7 > 0 then round(v[1] / n, 4) end as mean_size, case when k % 7 > 0 then round(v[2] / n, 4) end as least,
        case when k % 7 > 0 then round(v[3] / n, 4) end as greatest, case when k % 7 > 0 then round(10 * log10(high / low), 1) end as snr_est, case when k % 7 > 0 then round(len(list_filter(e, lambda x: x < 2 * low)) / len(e)::double, 5) end as silence_frac
    from n""")
def embedded_audio(spark, d):
    """From wav bytes to unit vectors and recording metrics: waves of four lengths, cut at a tenth of a second, in batches of four; every seventh can't be decoded."""
    number = F.substring("id", 9, 20).cast("long")
    some = F.slice("samples", F.lit(1), (16 + number % 4 * 16).cast("int"))
    data = wavs.as_wav(_waves(spark, d).withColumn("peak", F.array_max(F.transform("samples", lambda x: F.abs(x)))).withColumn("samples", F.when(F.col("peak") > 1, F.transform("samples", lambda x: (x / F.col("peak")).cast("float"))).otherwise(F.col("samples"))).withColumn("samples", some), 400)
    data = data.select("id", F.when(number % 7 == 0, F.encode(F.lit("no wave"), "UTF-8")).otherwise(F.col("wav")).alias("bytes"))
    out = plugs.embed_audio(data, _profile_of_rows, 0.1, target=400, batch=4)
    vector = [F.round(F.col("embedding")[k].cast("double"), 4).alias(c) for k, c in enumerate(("mean_size", "least", "greatest"))]
    return out.select("id", "failed", *vector, F.round(F.col("snr_est").cast("double"), 1).alias("snr_est"), F.round(F.col("silence_frac").cast("double"), 5).alias("silence_frac"))


@query("""with w as (select printf('segment_%06d', vec_id) as id, list_transform(embedding, lambda x: (x * 5)::float) as s from embeddings),
    p as (select id, s, list_max(list_transform(s, lambda x: abs(x)))::float as peak from w),
    i as (select id, list_transform(s, lambda x: round_even((case when peak > 1 then x / peak else x end)::float::double * 32767, 0)::bigint) as s from p)
    select id, id || '.wav' as name, 0.16::double as duration, len(s)::bigint as n, list_sum(s)::bigint as total, list_sum(list_transform(s, lambda x, k: x * k))::bigint as weighted from i""")
def exported(spark, d):
    """Waves exported to files, listed, read back and decoded."""
    folder = _folder(spark, "wavs")
    made = wavs.export_wavs(_waves(spark, d), folder, 400)
    back = wavs.decode(wavs.read_wavs(spark, folder)).join(wavs.list_wavs(spark, folder).select("id", F.regexp_extract("path", "[^/]*$", 0).alias("name")), "id")
    whole = F.transform("samples", lambda x: F.round(x.cast("double") * 32768).cast("long"))
    add = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + x)
    back = back.select("id", "name", F.size("samples").cast("long").alias("n"), add(whole).alias("total"), add(F.transform(whole, lambda x, k: x * (k + 1))).alias("weighted"))
    return made.select("id", "duration").join(back, "id")


def _speller(but: str):
    """A stand-in engine: letters by longest match; it fails on texts with a given one."""

    def spell(text: str) -> str:
        if but in text:
            raise ValueError(but)
        return text.lower()

    return plugs.tokenizing(v.SYMBOLS, spell)


_SPOKEN = f"""{v.CLIPS}, told as (select id, case when language not in ('en', 'de') or language is null then 'no plug' when contains(text, 'q') then 'ValueError' end as failed, ipa_units from clips),
    spoken as (select id, failed, case when failed is null then ipa_units else [] end as u from told)"""


@query(f"with {_SPOKEN} select id, failed, array_to_string(u, ' ') as ipa, len(u)::bigint as n_units from spoken")
def phonemised(spark, d):
    out = plugs.phonemise(v.clips(spark, d).select("id", "language", "text"), {k: _speller("q") for k in ("en", "de")})
    return out.select("id", "failed", units.join_units("units").alias("ipa"), F.size("units").cast("long").alias("n_units"))


@query(f"""with {_SPOKEN}, i as (select distinct unnest(u) as u from spoken), fresh as (select u as symbol, row_number() over (order by u) as k from i where u not in ('a', 'e', 'th', 's', 'z')),
    free as (select range as id, row_number() over (order by range) as k from range(256) where range not in (0, 1, 2, 3, 14, 18, 31, 200))
    select symbol, free.id::bigint as id, (select count(*) from spoken where failed is null)::bigint as spelled from fresh join free using (k)""")
def rederive_targets(spark, d):
    """The symbols that new targets add to a map, with their ids, and how many clips have new targets."""
    rows, extended, fresh = plugs.rederive_targets(v.clips(spark, d).select("id", "language", "text", F.concat(F.lit("spk_"), "language").alias("speaker")), {k: _speller("q") for k in ("en", "de")}, BASE)
    spelled = rows.filter("failed is null").count()
    return spark.createDataFrame([(x, extended[x][0], spelled) for x in fresh], "symbol string, id long, spelled long")
