"""One registered query an operator, over the derived speech-corpus views, with its DuckDB twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxtable.functions import classes, clips, units
from voxtable.operators import assemble, batching, manifests, quality, scoring, selection, speakers, symbols
from voxtable.plans import views as v
from voxtable.sources import corpus, manifest, wavs

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

MIN_CLIPS = 5


def query(sql: str | None = None):
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- quality -------------------------------------------------------------------------------------------------------


def _flagged(spark, d) -> DataFrame:
    return quality.qc_flags(quality.attach_speakers(v.spoken(spark, d), v.speakers(spark, d), MIN_CLIPS), quality.QcLimits(min_speaker_clips=MIN_CLIPS))


_FLAGGED = f"""with {v.CLIPS},{v.SPEAKERS},
    sizes as (select speaker, count(*) as clips from speakers group by speaker),
    joined as (select c.*, s.speaker as s0, s.speaker_idx as i0, z.clips as of_speaker from clips c left join speakers s on c.recording = s.id left join sizes z on s.speaker = z.speaker),
    flagged as (
        select *, coalesce(s0, 'spk_unknown') as speaker, coalesce(i0, -1) as speaker_idx, s0 is null or of_speaker < {MIN_CLIPS} as rare_speaker,
            concat_ws(',', case when n_units = 0 then 'no_phonemes' end, case when duration < 0.4::double then 'too_short' end, case when duration > 20.0::double then 'too_long' end,
                case when n_units / greatest(duration, 0.001::double) < 4 or n_units / greatest(duration, 0.001::double) > 25 then 'bad_rate' end,
                case when length(text) > 0 and n_units / length(text) < 0.35::double then 'short_vs_text' end,
                case when s0 is null or of_speaker < {MIN_CLIPS} then 'rare_speaker' end) as qc_reason
        from joined)"""


@query(f"{_FLAGGED} select id, speaker, speaker_idx, qc_reason = '' as qc_pass, qc_reason from flagged")
def qc_flags(spark, d):
    return _flagged(spark, d).select(F.col("clip").alias("id"), "speaker", "speaker_idx", "qc_pass", "qc_reason")


@query(f"""with {v.CLIPS},{v.SPEAKERS},
    entries as (select id, speaker, speaker_idx, 'a' as shard, speaker_idx as row_ from speakers union all select id, speaker || '_b', speaker_idx + 1, 'b', -speaker_idx from speakers where speaker_idx % 3 = 0
        union all select id, speaker || '_c', speaker_idx + 2, 'b', 1 from speakers where speaker_idx % 6 = 0),
    last as (select * from (select *, row_number() over (partition by id order by shard desc, row_ desc) as k from entries) where k = 1),
    sizes as (select speaker, count(*) as clips from entries group by speaker)
    select c.id, coalesce(s.speaker, 'spk_unknown') as speaker, coalesce(s.speaker_idx, -1) as speaker_idx, s.speaker is null or z.clips < {MIN_CLIPS} as rare_speaker
    from clips c left join last s on c.recording = s.id left join sizes z on s.speaker = z.speaker""")
def attach_last_speakers(spark, d):
    """A speaker table in which ids come again in later shards and rows: the last entry counts."""
    one = v.speakers(spark, d).select("id", "speaker", "speaker_idx", F.lit("a").alias("shard"), F.col("speaker_idx").alias("row"))
    other = lambda by, tail, k, row: one.filter(F.col("speaker_idx") % by == 0).select("id", F.concat("speaker", F.lit(tail)).alias("speaker"), F.col("speaker_idx") + k, F.lit("b"), row)
    entries = one.union(other(3, "_b", 1, -F.col("row"))).union(other(6, "_c", 2, F.lit(1).cast("long")))
    return quality.attach_speakers(v.spoken(spark, d), entries, MIN_CLIPS).select(F.col("clip").alias("id"), "speaker", "speaker_idx", "rare_speaker")


@query(f"""{_FLAGGED} select reason, count(*)::bigint as n, count(*) / (select count(*) from flagged)::double as share
    from (select unnest(string_split(qc_reason, ',')) as reason from flagged where qc_reason <> '') group by reason""")
def qc_reason_tally(spark, d):
    return quality.reason_tally(_flagged(spark, d))


@query(f"""{_FLAGGED} select count(*)::bigint as total, sum(case when qc_reason = '' then 1 else 0 end)::bigint as kept,
    sum(case when qc_reason = '' then dur_ms else 0 end)::bigint as kept_ms from flagged""")
def qc_summary(spark, d):
    return quality.qc_summary(_flagged(spark, d)).select("total", "kept", F.round(F.col("kept_hours") * 3_600_000).cast("long").alias("kept_ms"))


@query(f"{_FLAGGED} select sum(case when qc_reason = '' then 1 else 0 end)::bigint as written, sum(case when qc_reason <> '' then 1 else 0 end)::bigint as skipped from flagged")
def export_counts(spark, d):
    return quality.export_counts(_flagged(spark, d))


@query(f"with {v.SPEAKERS} select speaker, count(*)::bigint as clips, count(*) < {MIN_CLIPS} as small from speakers group by speaker")
def speaker_counts(spark, d):
    return quality.speaker_counts(v.speakers(spark, d), MIN_CLIPS)


@query(f"""with {v.SPEAKERS} select count(*)::bigint as speakers, sum((n < {MIN_CLIPS})::int)::bigint as small_speakers, sum((n >= {MIN_CLIPS})::int)::bigint as speakers_used
    from (select count(*) as n from speakers group by speaker)""")
def speaker_summary(spark, d):
    return quality.speaker_summary(v.speakers(spark, d), MIN_CLIPS)


@query(f"""with {v.CLIPS},{v.SPEAKERS} select c.id, coalesce(s.speaker, 'eng_unknown') as speaker, coalesce(s.snr_est, 0.0) as snr_est, coalesce(s.clip_frac, 0.0) as clip_frac,
    coalesce(s.silence_frac, 0.0) as silence_frac from clips c left join speakers s on c.recording = s.id""")
def attach_metrics(spark, d):
    return quality.attach_metrics(v.spoken(spark, d), v.speakers(spark, d)).select(F.col("clip").alias("id"), "speaker", "snr_est", "clip_frac", "silence_frac")


@query(f"with {v.CLIPS} select id, case when language = 'en' then 'en' else 'other' end as language from clips")
def fill_language(spark, d):
    rows = v.clips(spark, d).withColumn("language", F.when(F.col("language") == "en", "en").when(F.col("doc_id") % 2 == 0, ""))
    return quality.fill_language(rows, "other").select("id", "language")


@query(f"with {v.CLIPS} select id, dur_ms from clips where dur_ms >= 25000")
def over_limit(spark, d):
    return quality.over_limit(v.clips(spark, d), 25.0).select("id", "dur_ms")


@query(f"with {v.CLIPS} select id, n_units / greatest(duration, 0.001::double) as rate from clips")
def phoneme_rate(spark, d):
    return v.clips(spark, d).select("id", clips.phoneme_rate(F.col("n_units"), F.col("duration")).alias("rate"))


# ---- assembling ----------------------------------------------------------------------------------------------------


@query(f"""with {v.CLIPS} select split, count(*)::bigint as clips, round(sum(dur_ms) / 3600000.0::double, 2) as hours, sum(n_units)::bigint as phoneme_units, round(sum(n_units) / count(*)::double, 1) as mean_units_per_clip,
    sum((n_units = 0)::int)::bigint as empty_transcriptions from clips group by split""")
def corpus_stats(spark, d):
    return assemble.corpus_stats(v.clips(spark, d)).select("split", "clips", "hours", "phoneme_units", "mean_units_per_clip", "empty_transcriptions")


@query("select md5(coalesce(text, '')) as id, count(*)::bigint as n from documents group by all having count(*) > 1")
def duplicate_ids(spark, d):
    return assemble.duplicate_ids(v.table(spark, d, "documents").select(F.md5(F.coalesce("text", F.lit(""))).alias("id")))


@query("""with dups as (select md5(coalesce(text, '')) as id from documents group by 1 having count(*) > 1)
    select count(*)::bigint as n_duplicates, (select array_to_string(list(id order by id), ',') from (select id from dups order by id limit 5)) as examples from dups""")
def duplicate_report(spark, d):
    out = assemble.duplicate_report(v.table(spark, d, "documents").select(F.md5(F.coalesce("text", F.lit(""))).alias("id")))
    return out.select("n_duplicates", F.array_join("examples", ",").alias("examples"))


def _sourced(spark, d) -> tuple[DataFrame, DataFrame]:
    """Results and their source shards; rows are numbered inside a shard (a thousand documents of one source at most)."""
    rows = v.clips(spark, d).withColumn("row", F.row_number().over(W.partitionBy("shard").orderBy("id")) - 1)
    source = rows.select("shard", "row", F.col("id").alias("path"), F.encode("text", "UTF-8").alias("bytes"))
    results = rows.select("id", "shard", "row", F.col("id").alias("audio_path"), "ipa", "n_units")
    return results, source


_NUMBERED = f"{v.CLIPS}, numbered as (select *, row_number() over (partition by shard order by id) - 1 as row_ from clips)"


@query(f"with {_NUMBERED} select id, shard, row_::bigint as \"row\", n_units, md5(text) as audio_md5 from numbered")
def attach_audio(spark, d):
    results, source = _sourced(spark, d)
    audio = source.select("shard", "row", F.struct("bytes", "path").alias("audio"))
    out = assemble.attach_audio(results, audio, check=False)
    return out.select("id", "shard", F.col("row").cast("long").alias("row"), "n_units", F.md5(F.col("audio.bytes")).alias("audio_md5"))


@query(f"""with {_NUMBERED}, ends as (select shard, max(row_) as last_ from numbered group by shard),
    broken as (select n.shard, n.row_ as r, n.id, n.id <> case when row_ = 3 and n.shard like 'train-src1-%' then 'other' else n.id end as moved from numbered n join ends using (shard)
        where not (n.shard like 'test-%' and row_ = last_) and n.shard not like 'train-src2-%'),
    shards as (select shard, count(*) as n from broken group by shard), all_ as (select shard, count(*) as n from numbered group by shard)
    select a.shard, case when s.shard is null then 'missing_shard' else 'row_count' end as kind, null::double as "row" from all_ a left join shards s using (shard) where s.shard is null or s.n <> a.n
    union all select shard, 'path', min(r)::double from broken where moved group by shard""")
def audio_violations(spark, d):
    results, source = _sourced(spark, d)
    last = F.max("row").over(W.partitionBy("shard"))
    broken = source.select("shard", "row", "path", last.alias("last")).filter(~(F.col("shard").like("test-%") & (F.col("row") == F.col("last"))) & ~F.col("shard").like("train-src2-%"))
    moved = F.when((F.col("row") == 3) & F.col("shard").like("train-src1-%"), "other").otherwise(F.col("path"))
    return assemble.audio_violations(results, broken.withColumn("path", moved)).withColumn("row", F.col("row").cast("double"))


@query(f"with {v.CLIPS} select distinct shard from clips where shard like 'test-%'")
def missing_shards(spark, d):
    rows = v.clips(spark, d)
    return assemble.missing_shards(rows, rows.filter(F.col("shard").like("train-%")))


@query(f"with {v.CLIPS}, s as (select distinct shard from clips where contains(shard, 'src1') order by shard limit 3) select shard, count(*)::bigint as clips from clips where shard in (select shard from s) group by shard")
def select_shards(spark, d):
    return corpus.select_shards(v.clips(spark, d), "src1", 3).groupBy("shard").agg(F.count("*").alias("clips"))


@query(f"with {v.CLIPS} select shard, count(*)::bigint as clips from clips where shard not like 'test-%' group by shard")
def pending_shards(spark, d):
    rows = v.clips(spark, d)
    done = rows.filter(F.col("shard").like("test-%")).select(F.concat("shard", F.lit(".parquet")).alias("shard"))
    return corpus.pending_shards(rows, done).groupBy("shard").agg(F.count("*").alias("clips"))


@query("select count(*)::bigint as n, min(doc_id)::bigint as first_doc, sum(n_chars)::bigint as chars from documents")
def read_shards(spark, d):
    """Shards read with provenance: (shard, row) is unique, so distinct pairs are as many as the rows."""
    rows = corpus.read_shards(spark, f"{d}/documents.parquet", ["doc_id", "n_chars"])
    pairs = rows.groupBy("shard", "row").agg(F.sum("n_chars").alias("n_chars"), F.min("doc_id").alias("doc_id"))
    return pairs.agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.sum("n_chars").alias("chars"))


@query(f"""with {v.CLIPS}, ranked as (select id, split, row_number() over (partition by split order by id) - 1 as r, count(*) over (partition by split) as n from clips)
    select id, split, r::bigint as rank, printf('%s-%05d-of-%05d.parquet', split, (r // 1000)::bigint, ((n + 999) // 1000)::bigint) as file_name from ranked""")
def sidecar(spark, d):
    return corpus.sidecar(v.clips(spark, d).select("id", "shard", "n_units"), 1000).select("id", "split", F.col("rank").cast("long").alias("rank"), "file_name")


@query("""select page_id, case when regexp_extract(url, '([^/]*)$', 1) = '' then '' else regexp_replace(regexp_extract(url, '([^/]*)$', 1), '^(.+)\\.[^.]*$', '\\1') end as stem,
    printf('shard_%06d', page_id) as numbered, case when page_id % 3 = 0 then 'test' else 'train' end as split from pages""")
def clip_ids(spark, d):
    rows = v.table(spark, d, "pages").select("page_id", "url", F.concat(F.when(F.col("page_id") % 3 == 0, "test").otherwise("train"), F.lit("-0.parquet")).alias("shard"))
    return rows.select("page_id", clips.stem(F.col("url")).alias("stem"), clips.clip_id(F.lit(""), F.lit("shard.parquet"), F.col("page_id")).alias("numbered"), clips.split_of(F.col("shard")).alias("split"))


@query(f"with {v.CLIPS} select id, case when language = 'en' then n_units::double end as n_units, case when language <> 'en' then dur_ms::double end as dur_ms from clips")
def union_shards(spark, d):
    """A column that a part lacks is null there (doubles, as a null takes no whole number in a comparison of frames)."""
    rows = v.clips(spark, d).withColumns({c: F.col(c).cast("double") for c in ("n_units", "dur_ms")})
    return assemble.union_shards(rows.filter("language = 'en'").select("id", "n_units"), rows.filter("language <> 'en'").select("id", "dur_ms"))


@query(f"with {v.CLIPS} select id, n_units, '' as speaker from clips")
def select_present(spark, d):
    return assemble.select_present(v.clips(spark, d), ["id", "n_units", "speaker"], fill=True)


@query(f"with {v.CLIPS},{v.SPEAKERS} select c.id, s.speaker, c.n_units from clips c join speakers s on c.recording = s.id where s.snr_est >= 15")
def join_selected(spark, d):
    chosen = v.speakers(spark, d).withColumn("selected", F.col("snr_est") >= 15).select("id", "speaker", "selected")
    return assemble.join_selected(v.spoken(spark, d), chosen).select(F.col("clip").alias("id"), "speaker", "n_units")


@query(f"with {v.CLIPS},{v.SPEAKERS} select c.id from clips c where exists (select 1 from speakers s where s.id = c.recording)")
def restrict_ids(spark, d):
    return assemble.restrict_ids(v.spoken(spark, d), v.speakers(spark, d)).select(F.col("clip").alias("id"))


@query(f"with {v.CLIPS} select d.doc_id, c.id, c.ipa from documents d join clips c on d.doc_id = c.doc_id where c.line_no = 0")
def join_sidecar(spark, d):
    docs = v.table(spark, d, "documents").select("doc_id", F.format_string("segment_%06d_0000", "doc_id").alias("id"))
    return assemble.join_sidecar(docs, v.clips(spark, d).select("id", "ipa")).select("doc_id", "id", "ipa")


# ---- units and scoring -----------------------------------------------------------------------------------------------


@query(f"with {v.CLIPS} select id, ipa, n_units, md5(array_to_string(ipa_units, '|')) as units_md5, case when ipa = '' then 1 else n_units end as read_back from clips")
def with_ipa(spark, d):
    rows = v.clips(spark, d)
    return rows.select("id", units.join_units(F.col("ipa_units")).alias("ipa"), F.size("ipa_units").cast("long").alias("n_units"), F.md5(F.array_join("ipa_units", "|")).alias("units_md5"), F.size(units.split_units(F.col("ipa"))).cast("long").alias("read_back"))


_IDS = "list_transform(ipa_units, lambda u: case when u in ('a', 'e', ',') then 0 when u in ('th', 't') then 1 else 2 end)"


@query(f"""with {v.CLIPS}, i as (select id, {_IDS} as x from clips)
    select id, array_to_string(list_transform(list_filter(x, lambda y, k: y <> 0 and (k = 1 or y <> x[k - 1])), lambda y: case y when 1 then 'one' else 'two' end), ' ') as units from i""")
def ctc_collapse(spark, d):
    ids = F.transform("ipa_units", lambda u: F.when(u.isin("a", "e", ","), 0).when(u.isin("th", "t"), 1).otherwise(2))
    rows = v.clips(spark, d).withColumn("frames", ids)
    return rows.select("id", F.array_join(units.ctc_collapse(F.col("frames"), F.array(F.lit("-"), F.lit("one"), F.lit("two"))), " ").alias("units"))


@query("""with f as (select vec_id, list_transform(range(0, 8), lambda k: embedding[k * 8 + 1:k * 8 + 5]) as frames from embeddings)
    select vec_id, array_to_string(list_transform(frames, lambda x: list_position(x, list_max(x)) - 1), ',') as best from f""")
def argmax_frames(spark, d):
    frames = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.slice("embedding", k * 8 + 1, F.lit(8)))
    return v.table(spark, d, "embeddings").select("vec_id", F.array_join(units.argmax_frames(frames, 5), ",").alias("best"))


@query(f"with {v.CLIPS} select id, greatest(1, (dur_ms * 16) // 320)::bigint as frames, n_units / 16000.0::double as seconds from clips")
def valid_frames(spark, d):
    return v.clips(spark, d).select("id", units.valid_frames(F.col("dur_ms") * 16).cast("long").alias("frames"), (F.col("n_units") / F.lit(16000.0)).alias("seconds"))


@query(f"with {v.CLIPS} select id, round(dur_ms * 16 / 24000.0::double, 3) as rounded, cast(dur_ms * 16 / 24000.0::double as float)::double as single from clips")
def durations(spark, d):
    n, rate = F.col("dur_ms") * 16, F.lit(24000)
    return v.clips(spark, d).select("id", clips.round_duration(n, rate).alias("rounded"), clips.duration(n, rate).cast("double").alias("single"))


@query(f"with {v.CLIPS} select id, array_to_string(list_filter(ipa_units, lambda u: u not in (',', '.')), ' ') as units from clips")
def strip_punct(spark, d):
    return v.clips(spark, d).select("id", F.array_join(units.strip_punct(F.col("ipa_units")), " ").alias("units"))


@query(f"with {v.CLIPS} select id, array_to_string(list_filter(ipa_units, lambda u, k: k = 1 or u <> ipa_units[k - 1]), ' ') as units from clips")
def collapse_units(spark, d):
    return v.clips(spark, d).select("id", F.array_join(units.collapse(F.col("ipa_units")), " ").alias("units"))


@query(f"with {v.HYPOTHESES} select id, levenshtein(r, h)::bigint as distance, length(r)::bigint as ref_len, r = h as exact, length(h) = 0 as empty_hyp from coded")
def edit_distances(spark, d):
    return scoring.scored(v.hypotheses(spark, d)).select("id", "distance", "ref_len", "exact", "empty_hyp")


_UER = "count(*)::bigint as n, sum(levenshtein(r, h))::bigint as edits, sum(length(r))::bigint as ref_units, round(sum(levenshtein(r, h)) / greatest(sum(length(r)), 1)::double, 4) as uer, sum((r = h)::int)::bigint as exact, sum((length(h) = 0)::int)::bigint as empty_hyps"


@query(f"with {v.HYPOTHESES} select language, {_UER} from coded group by language union all select null, {_UER} from coded")
def uer_by_language(spark, d):
    return scoring.uer(v.hypotheses(spark, d), group="language")


@query(f"with {v.HYPOTHESES} select sum((r = h)::int)::bigint as exact, count(*)::bigint as n from coded")
def exact_match(spark, d):
    return scoring.exact_match(v.hypotheses(spark, d))


@query(f"with {v.HYPOTHESES} select sum((length(h) = 0)::int)::bigint as empty_hyps, count(*)::bigint as n from coded")
def empty_hyps(spark, d):
    return scoring.empty_hyps(v.hypotheses(spark, d))


@query(f"""with {v.HYPOTHESES}, a as (select round(sum(levenshtein(r, h)) / sum(length(r))::double, 4) as synth_uer from coded),
    b as (select round(sum(levenshtein(r, r[2:])) / sum(length(r))::double, 4) as real_uer, count(*)::bigint as n_real from coded where shard like 'test-%')
    select synth_uer, real_uer, n_real, round(synth_uer - real_uer, 4) as gap from a, b""")
def uer_gap(spark, d):
    rows = v.hypotheses(spark, d)
    real = rows.filter(F.col("shard").like("test-%")).withColumn("hyp", F.slice("ref", F.lit(2), F.size("ref")))
    return scoring.uer_gap(rows, real)


@query(f"with {v.HYPOTHESES} select id, array_to_string(ref[2:], ' ') as hyp from coded where shard like 'test-%'")
def floor_join(spark, d):
    rows = v.hypotheses(spark, d)
    real = rows.filter(F.col("shard").like("test-%")).select("id", F.slice("ref", F.lit(2), F.size("ref")).alias("hyp"))
    return scoring.floor_join(rows, real).select("id", F.array_join("hyp", " ").alias("hyp"))


@query(f"with {v.HYPOTHESES} select language, {_UER} from coded group by language union all select null, {_UER} from coded")
def target_shift(spark, d):
    rows = v.hypotheses(spark, d)
    return scoring.target_shift(rows.select("id", "language", F.col("ref").alias("units")), rows.select("id", F.col("hyp").alias("units")))


@query(f"with {v.HYPOTHESES} select {_UER}, case when count(*) = 0 then 'no overlap' else '' end as note from coded where language <> 'en'")
def regression(spark, d):
    rows = v.hypotheses(spark, d)
    return scoring.regression(rows.select("id", F.col("ref").alias("units")), rows.filter("language <> 'en'").select("id", F.col("hyp").alias("units")))


@query(f"with {v.HYPOTHESES} select id, array_to_string(ref, ' ') as ref, array_to_string(hyp, ' ') as hyp from coded where r <> h order by id limit 5")
def mismatches(spark, d):
    return scoring.mismatches(v.hypotheses(spark, d), 5, "id").select("id", F.array_join("ref", " ").alias("ref"), F.array_join("hyp", " ").alias("hyp"))


@query(f"""with {v.CLIPS}, n as (select id, list_filter(list_transform(ipa_units, lambda u: case u when 'x' then 'k' when 'g' then 'ɡ' when 'r' then 'ɹ' else u end), lambda u: u <> '') as u from clips)
    select id, array_to_string(list_filter(u, lambda x, k: k = 1 or x <> u[k - 1]), ' ') as units from n""")
def normalize_units(spark, d):
    rows = v.clips(spark, d)
    return rows.select("id", F.array_join(classes.normalize_units(F.col("ipa_units"), classes.unit_lookup(rows, "ipa_units")), " ").alias("units"))


@query("""with n as (select vec_id, embedding as e, sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) as n from embeddings)
    select vec_id, array_to_string(list_transform(e, lambda x: round(x::double / (n + 1e-9) * 1000000)::bigint), ' ') as millionths from n""")
def l2_normalize(spark, d):
    """All elements, in whole millionths."""
    unit = units.l2_normalize(F.col("embedding"))
    return v.table(spark, d, "embeddings").select("vec_id", F.array_join(F.transform(unit, lambda x: F.round(x * 1_000_000).cast("long").cast("string")), " ").alias("millionths"))


# ---- selection -------------------------------------------------------------------------------------------------------


def _agreed(spark, d) -> DataFrame:
    """Without units and other columns that no figure needs: rows with rare words are written once (see wordjoin)."""
    return selection.agreement(v.clips(spark, d).select("id", "recording", "text", "ipa", "n_units", "dur_ms", "duration"), v.lexicon(spark, d))


@query(f"with {v.agreement_sql()} select id, coverage, uer from agreed")
def agreement_scores(spark, d):
    return _agreed(spark, d).select("id", "coverage", "uer")


@query(f"""with {v.CLIPS},{v.LEXICON}, w as (select id, unnest(regexp_extract_all(lower(text), '[a-z'']+')) as word from clips),
    k as (select w.id, count(*) as n, count(l.word) as known, sum(len(l.phones)) as p from w left join lexicon l using (word) group by w.id)
    select clips.id, coalesce(known::double / n, 0.0) as coverage, coalesce(p, 0)::bigint as n_phones from clips left join k using (id)""")
def lexicon_lookup(spark, d):
    return selection.lexicon_lookup(v.clips(spark, d).select("id", "text"), v.lexicon(spark, d)).select("id", "coverage", F.size("phones").cast("long").alias("n_phones"))


_LIMITS = selection.Limits(min_seconds=1.0, max_seconds=40.0, min_coverage=0.6, max_uer=0.6, min_rate=3.0)


def _judged(spark, d) -> DataFrame:
    rows = _agreed(spark, d).withColumnsRenamed({"id": "clip", "recording": "id"})
    rows = quality.attach_metrics(rows, v.speakers(spark, d)).drop("id").withColumnRenamed("clip", "id")
    return selection.eligibility(rows, _LIMITS)


_JUDGED = f"""with {v.agreement_sql()},{v.SPEAKERS},
    measured as (select a.*, coalesce(s.speaker, 'eng_unknown') as speaker, coalesce(s.snr_est, 0.0) as snr_est, coalesce(s.clip_frac, 0.0) as clip_frac, coalesce(s.silence_frac, 0.0) as silence_frac,
        n_units / greatest(duration, 0.001::double) as rate from agreed a left join speakers s on a.recording = s.id),
    judged as (select *, concat_ws(',', case when duration < 1 or duration > 40 then 'duration' end, case when coverage < 0.6::double then 'low_coverage' end,
        case when coverage >= 0.6::double and uer > 0.6::double then 'text_audio_mismatch' end, case when snr_est < 15 then 'low_snr' end, case when clip_frac > 0.001::double then 'clipping' end,
        case when silence_frac > 0.5::double then 'mostly_silence' end, case when rate < 3 or rate > 25 then 'bad_rate' end) as why from measured)"""


@query(f"{_JUDGED} select id, why, why = '' as eligible from judged")
def eligibility(spark, d):
    return _judged(spark, d).select("id", "why", "eligible")


@query(f"{_JUDGED} select reason, count(*)::bigint as n, count(*) / (select count(*) from judged)::double as share from (select unnest(string_split(why, ',')) as reason from judged where why <> '') group by reason")
def eligibility_tally(spark, d):
    return quality.reason_tally(_judged(spark, d), "why")


@query(f"{_JUDGED} select id, row_number() over (order by uer, snr_est desc, id)::bigint as place from judged where why = ''")
def rank_candidates(spark, d):
    return selection.placed(_judged(spark, d).select("id", "uer", "snr_est", "eligible")).select("id", F.col("place").cast("long").alias("place"))


def _selected(spark, d) -> DataFrame:
    rows = corpus.stored(_judged(spark, d).select("id", "speaker", "eligible", "duration", "dur_ms", "uer", "snr_est"))  # several uses
    budget = 0.15 * (rows.agg(F.sum("dur_ms")).first()[0] or 0)
    return selection.select_budgeted(rows, budget, 0.08, duration="dur_ms")


_SELECTED = _JUDGED.replace("with ", "with recursive ", 1) + """,
    pick as materialized (select id, speaker, eligible, duration, dur_ms, uer, snr_est from (select *, why = '' as eligible from judged)),
    caps as materialized (select 0.15::double * sum(dur_ms) as budget from pick),
    ranked as materialized (select id, speaker, dur_ms, uer, snr_est, row_number() over (partition by speaker order by uer, snr_est desc, id) as k from pick where eligible),
    walk as (
        select distinct speaker, 0::bigint as k, ''::varchar as id, 0::double as total, false as kept from ranked
        union all
        select r.speaker, r.k, r.id, case when w.total + r.dur_ms <= 0.08::double * budget then w.total + r.dur_ms else w.total end, w.total + r.dur_ms <= 0.08::double * budget
        from walk w join ranked r on r.speaker = w.speaker and r.k = w.k + 1, caps),
    accepted as (select r.id, sum(r.dur_ms) over (order by r.uer, r.snr_est desc, r.id) - r.dur_ms as before_ from walk join ranked r on walk.id = r.id where kept),
    selected as (select p.*, p.id in (select a.id from accepted a, caps where before_ < budget) as selected from pick p)"""


@query(f"{_SELECTED} select id, speaker, eligible, selected from selected")
def select_budgeted(spark, d):
    return _selected(spark, d).select("id", "speaker", "eligible", "selected")


_SUMMARY = {"hours": 9, "uer_median": 9, "uer_p95": 9, "snr_median": 6, "duration_median": 6, "duration_mean": 6}


@query(f"""{_SELECTED} select count(*)::bigint as n, count(distinct speaker)::bigint as speakers, round(sum(duration) / 3600, 9) as hours, round(quantile_cont(uer, 0.5), 9) as uer_median,
    round(quantile_cont(uer, 0.95), 9) as uer_p95, round(quantile_cont(snr_est, 0.5), 6) as snr_median, round(quantile_cont(duration, 0.5), 6) as duration_median, round(avg(duration), 6) as duration_mean
    from selected where selected""")
def selection_summary(spark, d):
    return selection.selection_summary(_selected(spark, d)).select("n", "speakers", *(F.round(c, k).alias(c) for c, k in _SUMMARY.items()))


# ---- symbols ---------------------------------------------------------------------------------------------------------

#: A base map that knows some symbols, has one clash with the specials and a gap.
BASE = {"^": [1], "_": [0], "$": [2], " ": [3], "a": [14], "e": [18], "th": [3], "s": [31], "z": [200]}


def _map(spark, d, rows: DataFrame | None = None) -> symbols.SymbolMap:
    found = symbols.collected(symbols.symbol_inventory(v.clips(spark, d) if rows is None else rows, "ipa_units"))
    return symbols.language_tokens(symbols.build_symbol_map(found, BASE), ["de", "en", "es", "fr"])


def _map_rows(spark, mapping) -> DataFrame:
    return spark.createDataFrame([(k, int(x[0])) for k, x in mapping.items()], "symbol string, id long")


_MAP = f"""{v.CLIPS}, inventory as (select distinct unnest(ipa_units) as u from clips),
    specials(symbol, id) as (values ('^', 1), ('_', 0), ('$', 2), (' ', 3)), base(symbol, id) as (values ('a', 14), ('e', 18), ('s', 31), ('z', 200)),
    reused as (select symbol, id from base where symbol in (select u from inventory)),
    taken as (select id from specials union all select id from reused),
    fresh as (select u as symbol, row_number() over (order by u) as k from inventory where u not in (select symbol from base)),
    free as (select range as id, row_number() over (order by range) as k from range(256) where range not in (select id from taken)),
    mapped as (select symbol, id from specials union all select symbol, id from reused union all select symbol, free.id from fresh join free using (k)),
    tokens as (select '«' || l || '»' as symbol, (select max(id) from mapped) + k as id from (values ('de', 1), ('en', 2), ('es', 3), ('fr', 4)) t(l, k)),
    symbols as (select symbol, id::bigint as id from mapped union all select symbol, id::bigint from tokens)"""


@query(f"with {_MAP} select symbol, id from symbols")
def symbol_map(spark, d):
    return _map_rows(spark, _map(spark, d))


@query(f"with {v.CLIPS}, i as (select distinct unnest(ipa_units) as unit from clips) select unit from i where unit not in ('a', 'e', 'th', 's', 'z')")
def fresh_symbols(spark, d):
    return symbols.fresh_symbols(v.clips(spark, d), BASE, "ipa_units")


@query(f"""with {v.CLIPS}, i as (select distinct unnest(ipa_units) as u from clips), fresh as (select u as symbol, row_number() over (order by u) as k from i where u not in ('a', 'e', 'th', 's', 'z')),
    free as (select range as id, row_number() over (order by range) as k from range(256) where range not in (0, 1, 2, 3, 14, 18, 31, 200))
    select symbol, free.id::bigint as id from fresh join free using (k)""")
def extended_symbols(spark, d):
    rows = v.clips(spark, d)
    fresh = symbols.collected(symbols.fresh_symbols(rows, BASE, "ipa_units"))
    extended = symbols.extend_symbol_map(BASE, fresh)
    return _map_rows(spark, {k: extended[k] for k in fresh})


@query(f"with {_MAP} select s.symbol, s.id::int as new_id, b.id::int as base_id from symbols s join (values ('b', 77), ('c', 78), ('zz', 79)) b(symbol, id) on s.symbol = b.symbol")
def graft_table(spark, d):
    other = {"b": [77], "c": [78], "zz": [79]}
    mapping = _map(spark, d)
    return symbols.graft_table(spark.range(1), mapping, other, [s for s in mapping if s in other])


def _encoded(spark, d) -> DataFrame:
    rows = corpus.settled(v.clips(spark, d).select("id", "shard", "language", "text", "ipa_units"))  # the map comes from the same units
    mapping = {k: x for k, x in _map(spark, d, rows).items() if k != "q"}
    rows = rows.withColumn("split", clips.split_of(F.col("shard"))).withColumn("speaker", F.concat(F.lit("spk_"), "language"))
    return symbols.encoded(rows, mapping, "ipa_units")


_ENCODED = f"""with {_MAP}, spelled as (select id, unnest(ipa_units) as u, unnest(range(len(ipa_units))) as at_ from clips),
    coded as (select p.id, count(*) as n, count(s.id) as known, string_agg(s.id || ' 0', ' ' order by at_) as body from spelled p left join symbols s on p.u = s.symbol and s.symbol <> 'q' group by p.id),
    encoded as (select c.*, 'spk_' || c.language as speaker, case when e.n = e.known then '1 0 ' || t.id || ' 0 ' || e.body || ' 2' end as ids
        from clips c left join coded e on c.id = e.id left join symbols t on t.symbol = '«' || c.language || '»')"""


@query(f"{_ENCODED} select id, ids from encoded")
def encode_ids(spark, d):
    return _encoded(spark, d).select("id", F.array_join("ids", " ").alias("ids"))


@query(f"""{_ENCODED} select id, case when split = 'test' then 'val' else 'train' end as "set",
    id || '.wav|' || speaker || '|' || trim(regexp_replace(text, '[|"\\r\\n\\t]+', ' ', 'g')) || '|' || ids as line from encoded where ids is not null""")
def training_lines(spark, d):
    return manifest.training_lines(_encoded(spark, d))


@query(f"{_ENCODED} select split, sum((ids is null)::int)::bigint as dropped, sum((ids is not null)::int)::bigint as written from encoded group by split")
def dropped_count(spark, d):
    return symbols.dropped_count(_encoded(spark, d))


@query(f"with {_MAP}, spelled as (select id, unnest(ipa_units) as u, unnest(range(len(ipa_units))) as at_ from clips) select c.id, m.ids from clips c left join (select p.id, string_agg(s.id::varchar, ' ' order by at_) as ids from spelled p join symbols s on p.u = s.symbol group by p.id) m on c.id = m.id where len(c.ipa_units) > 0")
def map_units(spark, d):
    known = symbols.map_column(_map(spark, d))
    rows = v.clips(spark, d).filter(F.size("ipa_units") > 0)
    return rows.select("id", F.array_join(F.transform(units.map_units(F.col("ipa_units"), known), lambda x: F.get(x, F.lit(0)).cast("string")), " ").alias("ids"))


@query(f"""with {v.CLIPS}, s as (select id, list_filter(ipa_units, lambda u: u not in ('q', 'x', 'z', ',')) as u, array_to_string(list_sort(list_distinct(list_filter(ipa_units, lambda u: u in ('q', 'x', 'z', ',')))), ' ') as bad from clips)
    select id, bad, array_to_string(u, ' ') as units from s where len(u) > 0""")
def unsayable(spark, d):
    known = [s for s in v.SYMBOLS if s not in ("q", "x", "z", ",")]
    out = symbols.unsayable(v.clips(spark, d), known, "ipa_units")
    return out.select("id", F.array_join("bad", " ").alias("bad"), F.array_join("ipa_units", " ").alias("units"))


@query(f"with {v.SPEAKERS} select count(distinct speaker)::bigint as speakers, count(distinct speaker) >= 2 as trainable from speakers where speaker <> ''")
def speaker_gate(spark, d):
    return symbols.speaker_gate(v.speakers(spark, d))


@query(f"with {v.CLIPS}, i as (select distinct unnest(ipa_units) as u from clips) select u as symbol, ascii(u)::int as id from i where u not in (',', '.')")
def read_tokens(spark, d):
    found = symbols.symbol_inventory(v.clips(spark, d), "ipa_units")
    line = F.when(F.col("unit").isin(",", "."), F.concat(F.lit("<"), "unit", F.lit("> 7"))).otherwise(F.concat_ws(" ", "unit", F.ascii("unit")))
    return manifest.real_units(manifest.parse_tokens(found.select(line.alias("line")).unionByName(found.select(F.lit("").alias("line")))))


@query(f"with {v.CLIPS} select language, count(*)::bigint as n, sum(n_units)::bigint as ids from clips group by language")
def symbol_map_json(spark, d):
    """Maps written as JSON, bare and nested in turn, and read back."""
    rows = v.clips(spark, d).groupBy("language").agg(F.count("*").alias("n"), F.sum("n_units").alias("ids"))
    bare = F.to_json(F.create_map(F.lit("n"), F.array("n"), F.lit("ids"), F.array("ids")))
    nested = F.concat(F.lit('{"phoneme_id_map": '), bare, F.lit("}"))
    read = rows.select("language", manifest.parse_symbol_map(F.when(F.col("language") == "en", nested).otherwise(bare)).alias("m"))
    return read.select("language", *(F.get(F.element_at("m", F.lit(c)), F.lit(0)).cast("long").alias(c) for c in ("n", "ids")))


# ---- manifests -------------------------------------------------------------------------------------------------------


def _manifest(spark, d) -> DataFrame:
    rows = v.clips(spark, d)
    return rows.select("id", F.concat(F.lit("spk"), F.col("doc_id") % 7).alias("speaker"), clips.split_of(F.col("shard")).alias("split"), "duration", F.concat("text", F.lit('\t"a\\b"\r\n')).alias("text"), "ipa", F.col("n_units").cast("int").alias("n_units"), "language", (F.col("doc_id") * 10000 + F.col("line_no")).alias("line_no"), "dur_ms")


_MANIFEST = f"""{v.CLIPS}, manifest as (select id, 'spk' || doc_id % 7 as speaker, split, duration, text || chr(9) || '"a\\b"' || chr(13) || chr(10) as text, ipa, n_units, language, doc_id * 10000 + line_no as line_no, dur_ms from clips)"""
_ESCAPED = r"""replace(replace(replace(replace(replace(text, '\', '\\'), chr(9), '\' || chr(9)), '"', '\"'), chr(13), '\' || chr(13)), chr(10), '\' || chr(10))"""


@query(f"with {_MANIFEST} select md5(id || chr(9) || speaker || chr(9) || split || chr(9) || {_ESCAPED} || chr(9) || ipa || chr(9) || n_units || chr(9) || language) as line from manifest")
def manifest_lines(spark, d):
    out = manifest.manifest_lines(_manifest(spark, d), ("id", "speaker", "split", "text", "ipa", "n_units", "language"))
    return out.select(F.md5("line").alias("line"))


@query(f"with {_MANIFEST} select id, speaker, split, duration, md5(text) as text_md5, ipa, n_units::int as n_units, language from manifest")
def manifest_parse(spark, d):
    """Records written and parsed again."""
    out = manifest.parse_lines(manifest.manifest_lines(_manifest(spark, d)))
    return out.select("id", "speaker", "split", "duration", F.md5("text").alias("text_md5"), "ipa", "n_units", "language")


@query(f"with {_MANIFEST} select id from manifest where split = 'test'")
def val_manifest(spark, d):
    return manifest.val_manifest(_manifest(spark, d)).select("id")


@query(f"with {_MANIFEST} select language, count(*)::bigint as clips, sum(dur_ms)::bigint as ms, count(distinct speaker)::bigint as speakers from manifest group by language union all select null, count(*), sum(dur_ms)::bigint, count(distinct speaker) from manifest")
def manifest_summary(spark, d):
    out = manifests.manifest_summary(_manifest(spark, d))
    return out.select("language", "clips", F.round(F.col("hours") * 3_600_000).cast("long").alias("ms"), "speakers")


@query(f"with {_MANIFEST} select id, line_no from manifest where language = 'de' order by line_no limit 50")
def manifest_slice(spark, d):
    return manifests.manifest_slice(_manifest(spark, d), "de", 50).select("id", "line_no")


@query(f"""with {_MANIFEST} select language, speaker, clips, rank from (select language, speaker, count(*)::bigint as clips, row_number() over (partition by language order by count(*) desc, min(line_no))::int as rank
    from manifest group by language, speaker) where rank <= 3""")
def top_speakers(spark, d):
    return manifests.top_speakers(_manifest(spark, d), 3)


@query(f"with {_MANIFEST} select id, language, 'old' as origin from manifest where language <> 'en' union all select id || '_new', 'en', 'new' from manifest where language = 'en'")
def merge_manifest(spark, d):
    rows = _manifest(spark, d).withColumn("origin", F.lit("old")).withColumn("language", F.when(F.col("language") == "fr", "").otherwise(F.col("language")))
    new = rows.filter("language = 'en'").select(F.concat("id", F.lit("_new")).alias("id"), F.lit("new").alias("origin"))
    return manifests.merge_manifest(rows.select("id", "language", "origin"), new, "en", "fr")


@query(f"""with {_MANIFEST}, s as (select language, speaker from (select language, speaker, row_number() over (partition by language order by count(*) desc, min(line_no)) as k from manifest group by language, speaker) where k <= 2)
    select printf('ood_%s_%02d_%s', m.language, m.line_no::bigint, s.speaker) as id, s.speaker, 'test' as split, 0.0::double as duration, ipa, n_units::int as n_units, m.language
    from manifest m join s on m.language = s.language where n_units > 0""")
def synth_manifest(spark, d):
    rows = _manifest(spark, d)
    sentences = rows.filter("n_units > 0").select(F.col("language").alias("lang"), F.col("line_no").alias("number"), "text", F.split("ipa", " ").alias("units"))
    chosen = manifests.top_speakers(rows, 2).select(F.col("language").alias("lang"), "speaker")
    return manifests.synth_manifest(sentences, chosen).drop("text")


@query(f"""{_ENCODED}, ids_(speaker, speaker_id) as (values ('spk_de', 0), ('spk_en', 1), ('spk_es', 2))
    select id, md5(ids) as ids_md5, speaker_id::int as speaker_id from encoded join ids_ using (speaker) where ids is not null order by id limit 200""")
def synthesis_requests(spark, d):
    known = spark.createDataFrame([("spk_de", 0), ("spk_en", 1), ("spk_es", 2)], "speaker string, speaker_id int")
    out = manifests.synthesis_requests(_encoded(spark, d).withColumn("line_no", F.col("id")), known, limit=200)
    return out.select("id", F.md5(F.array_join("ids", " ")).alias("ids_md5"), "speaker_id")


@query(f"""{_ENCODED} select sum((ids is not null and language <> 'fr')::int)::bigint as kept, sum((ids is null)::int)::bigint as unmappable, sum((ids is not null and language = 'fr')::int)::bigint as unknown_speaker from encoded""")
def request_counts(spark, d):
    known = spark.createDataFrame([("spk_de", 0), ("spk_en", 1), ("spk_es", 2)], "speaker string, speaker_id int")
    return manifests.request_counts(_encoded(spark, d), known)


def _switched(spark, d) -> DataFrame:
    """Turns whose fourth word, in every third turn, is a bracketed span."""
    rows = v.table(spark, d, "conversations").select(F.concat_ws("_", "conv_id", "turn").alias("id"), "turn", F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("text", F.when(F.col("turn") % 3 == 0, F.regexp_replace("text", r"([A-Za-z]+)([.,])", r"[$1]$2")).otherwise(F.col("text")))


_SWITCHED = r"""turns as (select conv_id || '_' || turn as id, turn, case when turn % 3 = 0 then regexp_replace(coalesce(text, ''), '([A-Za-z]+)([.,])', '[\1]\2', 'g') else coalesce(text, '') end as text from conversations),
    cut as (select id, string_split(replace(text, ']', '['), '[') as parts from turns),
    spans as (select id, unnest(range(len(parts))) as k, trim(regexp_replace(unnest(parts), '^\s+|\s+$', '', 'g')) as span from cut),
    kept as (select id, row_number() over (partition by id order by k) - 1 as pos, case when k % 2 = 1 then 'eng' else 'twi' end as lang, span from spans where span <> '')"""


@query(f"with {_SWITCHED} select id, pos::int as pos, lang, span from kept")
def switch_spans(spark, d):
    return manifests.span_rows(_switched(spark, d), "twi")


@query(f"""with {_SWITCHED}, u as (select id, pos, span, case when lang = 'eng' then ['<', span, '>'] else regexp_extract_all(lower(span), '{v.UNIT_PATTERN}') end as units from kept)
    select id, md5(array_to_string(flatten(list(units order by pos)), ' ')) as units_md5, sum(len(units))::bigint as n_units, sum((len(units) = 0)::int)::bigint as n_unknown,
        md5(coalesce(array_to_string(list(span order by pos) filter (where len(units) = 0), '|'), '')) as unknown_md5 from u group by id""")
def mixed_units(spark, d):
    """Spans phonemised each by its language and put together again."""
    rows = manifests.span_rows(_switched(spark, d), "twi")
    own = F.when(F.col("lang") == "eng", F.array(F.lit("<"), "span", F.lit(">"))).otherwise(units.tokenize(F.lower("span"), v.SYMBOLS))
    out = manifests.joined_spans(rows.withColumn("units", own))
    unknown = F.size("unknown").cast("long").alias("n_unknown"), F.md5(F.array_join("unknown", "|")).alias("unknown_md5")
    return out.select("id", F.md5(F.array_join("units", " ")).alias("units_md5"), F.size("units").cast("long").alias("n_units"), *unknown)


@query(r"""with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as text, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as k from documents),
    t as (select doc_id, k, regexp_replace(text, '^\s+|\s+$', '', 'g') as text from l) select doc_id, (row_number() over (partition by doc_id order by k) - 1)::int as number, md5(text) as text_md5 from t where text <> ''""")
def sentence_lines(spark, d):
    rows = v.table(spark, d, "documents").select("doc_id", F.posexplode(manifest.sentences_of(F.coalesce("text", F.lit("")))).alias("number", "text"))
    return rows.select("doc_id", "number", F.md5("text").alias("text_md5"))


@query(r"""select doc_id, md5(trim(regexp_replace(text, '[|"\r\n\t]+', ' ', 'g'))) as text_md5 from documents""")
def sanitize_text(spark, d):
    return v.table(spark, d, "documents").select("doc_id", F.md5(clips.sanitize_text(F.col("text"))).alias("text_md5"))


@query(f"with {v.CLIPS} select id, case when ('0x' || substr(md5(id), 1, 8))::bigint % 10000 / 10000.0::double < 0.02::double then 'test' else 'train' end as split from clips")
def hash_split(spark, d):
    return v.clips(spark, d).select("id", clips.hash_split(F.col("id")).alias("split"))


# ---- batches and speakers --------------------------------------------------------------------------------------------


def _lengths(spark, d) -> DataFrame:
    return v.clips(spark, d).select("id", "shard", F.when((F.col("doc_id") + F.col("line_no")) % 2 == 0, 24000).otherwise(16000).alias("rate"), batching.length_at(F.col("dur_ms") * 24, F.lit(24000)).alias("length"))


_BATCHED = f"""with recursive {v.CLIPS},
    lengths as materialized (select *, row_number() over (partition by shard, rate order by length, id) as k
        from (select id, shard, case when (doc_id + line_no) % 2 = 0 then 24000 else 16000 end as rate, dur_ms * 16 as length from clips)),
    walk as (
        select shard, rate, k, id, length, 0::bigint as batch, 1::bigint as size from lengths where k = 1
        union all
        select l.shard, l.rate, l.k, l.id, l.length, case when (w.size + 1) * l.length > 2000000 or w.size >= 64 then w.batch + 1 else w.batch end,
            case when (w.size + 1) * l.length > 2000000 or w.size >= 64 then 1 else w.size + 1 end
        from walk w join lengths l on l.shard = w.shard and l.rate = w.rate and l.k = w.k + 1)"""


@query(f"{_BATCHED} select shard, rate, id, length, batch from walk")
def padded_batches(spark, d):
    return batching.padded_batches(_lengths(spark, d), 2_000_000, 64)


@query(f"{_BATCHED} select shard, rate, batch, count(*)::bigint as rows, max(length)::bigint as longest, (count(*) * max(length))::bigint as padded from walk group by shard, rate, batch")
def batch_report(spark, d):
    return batching.batch_report(batching.padded_batches(_lengths(spark, d), 2_000_000, 64))


@query(f"with {v.CLIPS} select shard, id, dur_ms * 16 as length, ((row_number() over (partition by shard order by dur_ms, id) - 1) // 64)::bigint as batch from clips")
def fixed_batches(spark, d):
    return batching.fixed_batches(_lengths(spark, d))


@query(f"""with {v.CLIPS}, b as (select shard, (doc_id + line_no) % 2 as r, ((row_number() over (partition by shard order by dur_ms, id) - 1) // 64)::bigint as batch from clips)
    select shard, batch, count(distinct r)::bigint as rates from b group by shard, batch having count(distinct r) > 1""")
def mixed_rates(spark, d):
    rows = _lengths(spark, d)
    return batching.mixed_rates(batching.fixed_batches(rows).join(rows.select("id", "rate"), "id"))


@query(f"""with {v.SPEAKERS}, z as (select speaker, count(*) as n from speakers group by speaker)
    select count(*)::bigint as speakers, median(n)::double::int as median_clips, max(n)::bigint as max_clips, max(n) / sum(n)::double as max_share, sum((n = 1)::int)::bigint as singletons from z""")
def cluster_report(spark, d):
    return speakers.cluster_report(v.speakers(spark, d))


@query(f"with {v.SPEAKERS} select speaker, count(*)::bigint as clips from speakers group by speaker order by clips desc, speaker limit 5")
def top_clusters(spark, d):
    return speakers.top_clusters(v.speakers(spark, d))


@query(f"with {v.SPEAKERS} select round(quantile_cont(snr_est, 0.05), 6) as p5, round(quantile_cont(snr_est, 0.5), 6) as median, round(quantile_cont(snr_est, 0.95), 6) as p95 from speakers")
def snr_report(spark, d):
    return speakers.snr_report(v.speakers(spark, d)).select(*(F.round(c, 6).alias(c) for c in ("p5", "median", "p95")))


@query("""with recursive e as (select printf('segment_%06d', vec_id) as id, embedding as x from embeddings),
    z as (select id, x, sqrt(list_sum(list_transform(x, lambda y: y::double * y::double))) + 1e-9 as norm from e),
    q as (select id, list_transform(x, lambda y: round(y::double / norm * 32768)::double) as q from z),
    named as (select distinct md5(array_to_string(list_transform(q, lambda y: y::int), ',')) as name, q from q),
    k as (select greatest(2, least(4000, count(*) // 4)) as k from q),
    state as (
        select 0 as turn, cid::bigint as cid, q as c from (select row_number() over (order by name) as cid, q from named), k where cid <= k
        union all
        select turn, cid, list(c order by i) as c
        from (
            select turn + 1 as turn, cid, i, floor((2 * sum(x) + count(*)) / (2 * count(*))) as c
            from (
                select turn, cid, unnest(q) as x, generate_subscripts(q, 1) as i
                from (select id, q, min(turn) as turn, arg_min(cid, (dist, cid)) as cid from (select id, q, turn, cid, list_dot_product(c, c) - 2 * list_dot_product(q, c) as dist from q, state where turn < 20) group by id, q))
            group by turn, cid, i)
        group by turn, cid),
    centers as (select row_number() over (order by c) - 1 as centroid, c from state where turn = 20),
    put as (select id, arg_min(centroid, (dist, centroid)) as centroid from (select id, centroid, list_dot_product(c, c) - 2 * list_dot_product(q, c) as dist from q, centers) group by id)
    select id, centroid::bigint as centroid, count(*) over (partition by centroid)::bigint as clips from put""")
def oversegmented(spark, d):
    """Every clip's centroid of a k-means in whole numbers, and how many share it."""
    rows = v.table(spark, d, "embeddings").select(F.format_string("segment_%06d", "vec_id").alias("id"), "embedding")
    out = speakers.oversegment(rows)[0]
    return out.select("id", F.col("centroid").cast("long").alias("centroid"), F.count("*").over(W.partitionBy("centroid")).alias("clips"))


@query()
def pseudo_speakers(spark, d):
    rows = v.table(spark, d, "embeddings").select(F.format_string("segment_%06d", "vec_id").alias("id"), "embedding")
    return speakers.pseudo_speakers(rows).select("id", "speaker", "speaker_idx")


def _waves(spark, d) -> DataFrame:
    """Embeddings read as short waves: 400 samples a second, so a 20 ms frame is 8 samples."""
    return v.table(spark, d, "embeddings").select(F.format_string("segment_%06d", "vec_id").alias("id"), F.transform("embedding", lambda x: (x * 5).cast("float")).alias("samples"), F.lit(400).alias("rate"))


_METRICS = """with w as (select printf('segment_%06d', vec_id) as id, list_transform(embedding, lambda x: (x * 5)::float::double) as s from embeddings),
    e as (select id, s, list_sort(list_transform(range(0, 8), lambda k: list_sum(list_transform(s[k * 8 + 1:k * 8 + 8], lambda x: x * x)) / 8 + 1e-12)) as e from w),
    p as (select *, e[1] + (e[2] - e[1]) * 0.7::double as low, e[7] + (e[8] - e[7]) * 0.3::double as high from e)
    select id, round(10 * log10(high / low), 2) as snr_est, len(list_filter(s, lambda x: abs(x) > 0.99::double)) / 64.0::double as clip_frac, len(list_filter(e, lambda x: x < 2 * low)) / 8.0::double as silence_frac from p"""


@query(_METRICS)
def acoustic_metrics(spark, d):
    return wavs.metrics(_waves(spark, d)).select("id", F.round("snr_est", 2).alias("snr_est"), "clip_frac", "silence_frac")


@query(_METRICS)
def acoustic_metrics_sql(spark, d):
    return wavs.metrics_sql(_waves(spark, d)).select("id", F.round("snr_est", 2).alias("snr_est"), "clip_frac", "silence_frac")


@query("""with w as (select printf('segment_%06d', vec_id) as id, list_transform(embedding, lambda x: (x * 5)::float) as s from embeddings),
    p as (select id, s, list_max(list_transform(s, lambda x: abs(x)))::float as peak from w),
    i as (select id, list_transform(s, lambda x: round_even((case when peak > 1 then x / peak else x end)::float::double * 32767, 0)::bigint) as s from p)
    select id, len(s)::bigint as n, 400 as rate, 0.16::double as duration, list_sum(s)::bigint as total, list_sum(list_transform(s, lambda x, k: x * k))::bigint as weighted from i""")
def wav_roundtrip(spark, d):
    """Waves written as PCM_16 bytes and decoded again; sums over the whole samples, plain and weighted by place."""
    out = wavs.decode(wavs.as_wav(_waves(spark, d), 400).select("id", "wav"), "wav")
    whole = F.transform("samples", lambda x: F.round(x.cast("double") * 32768).cast("long"))
    add = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + x)
    weighted = F.transform(whole, lambda x, k: x * (k + 1))
    return out.select("id", F.size("samples").cast("long").alias("n"), "rate", F.round(F.col("duration").cast("double"), 3).alias("duration"), add(whole).alias("total"), add(weighted).alias("weighted"))


@query("""with w as (select printf('segment_%06d', vec_id) as id, list_transform(embedding, lambda x: (x * 5)::float::double) as s from embeddings),
    o as (select id, s, unnest(range(32)) as k from w),
    t as (select id, k, unnest(s) as x, unnest(range(64)) as j from o),
    h as (select id, k, x, (j - 2 * k) / 2.0::double * 0.99::double as t from t where abs((j - 2 * k) / 2.0::double * 0.99::double) < 6),
    r as (select id, k, sum(x * case when t = 0 then 1.0::double else sin(pi() * t) / (pi() * t) end * cos(t * pi() / 12) ** 2 * 0.495::double) as y from h group by id, k)
    select id, count(*)::bigint as n, round(sum(y), 2) as total, round(sum(y * (k + 1)), 1) as weighted from r group by id""")
def resampled(spark, d):
    """Waves at half their rate by a windowed sinc, decoded at the source's rate."""
    out = wavs.resampled(_waves(spark, d), 200, "double")
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda n, x: n + x)
    y = F.col("samples")
    return out.select("id", F.size("samples").cast("long").alias("n"), F.round(add(y), 2).alias("total"), F.round(add(F.transform(y, lambda x, k: x * (k + 1))), 1).alias("weighted"))
