"""Scoring a second language by text-audio agreement, and the budgeted, capped choice of its best clips."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.functions.classes import collapsed_ipa_classes, collapsed_letters, phone_classes
from voxtable.functions.clips import phoneme_rate, reasons
from voxtable.functions.distance import string_distance
from voxtable.operators import wordjoin
from voxtable.operators.quantiles import number, quantiles
from voxtable.operators.walk import WALK_ROWS, within_cap
from voxtable.sources.corpus import prefix_sums, settled, stored


@dataclass(frozen=True)
class Limits:
    min_seconds: float = 2.0
    max_seconds: float = 15.0
    min_coverage: float = 0.7
    max_uer: float = 0.40
    min_snr: float = 15.0
    max_clip_frac: float = 0.001
    max_silence_frac: float = 0.5
    min_rate: float = 10.0
    max_rate: float = 25.0


#: A lexicon of so many bytes at most is sent to all tasks, which then look words up where the rows are; of a larger one the most frequent words are (see wordjoin).
LEXICON_BYTES = 64 << 20


def one_pronunciation(lexicon: DataFrame, order: str | None = None) -> DataFrame:
    """word, phones: of a word's pronunciations the first by the column ``order``; without one, the least."""
    return lexicon.groupBy("word").agg((F.min("phones") if order is None else F.min_by("phones", order)).alias("phones"))


def lexicon_lookup(df: DataFrame, lexicon: DataFrame, text: str = "text", id_: str = "id", order: str | None = None, most: int = LEXICON_BYTES) -> DataFrame:
    """df with phones (of the known words, in order) and coverage = known / words (0 without words).

    lexicon: word, phones. Of a word's pronunciations the first by the column ``order`` counts; without one, the least.
    """
    lexicon = stored(one_pronunciation(lexicon, order))
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z']+"), F.lit(0))
    size = lexicon.agg(F.sum(F.octet_length("word") + F.octet_length(F.array_join("phones", " ")) + 16)).first()[0] or 0
    if size <= most:
        entries = wordjoin.Entries(lexicon)
        found = df.withColumn("all_words", words).withColumn("looked", _lookup(lexicon, entries)(*wordjoin.sent_words(F.col("all_words"))))
        phones = wordjoin.apart(F.col("looked.phones"), F.col("looked.n_phones"), entries.odd).alias("phones")
        return found.select(*df.columns, phones, (F.col("looked.known") / F.greatest(F.col("looked.n"), F.lit(1))).alias("coverage"))
    return wordjoin.looked_up(df, lexicon, words, id_, most)


def _lookup(lexicon: DataFrame, entries: wordjoin.Entries):
    """A vectorised column function: words and their hashes -> struct of the joined phones of the known ones, their number and those of the known and of all words. No row is exploded or moved."""
    sent = lexicon.sparkSession.sparkContext.broadcast(entries)

    @F.arrow_udf("struct<phones:string,n_phones:int,known:int,n:int>")
    def look(words: pa.Array, hashes: pa.Array) -> pa.Array:
        entries, n = sent.value, len(words)
        sizes, all_words, all_hashes = wordjoin.flat(words, hashes)
        has, index = entries.find(all_words, all_hashes)
        row = np.repeat(np.arange(n), sizes)[has]
        phones, n_phones = entries.phones_of(row, index, n)
        return pa.StructArray.from_arrays([phones, *map(wordjoin.ints, (n_phones, np.bincount(row, minlength=n), sizes))], ["phones", "n_phones", "known", "n"])

    return look


def agreement(df: DataFrame, lexicon: DataFrame, order: str | None = None) -> DataFrame:
    """df (id, text, ipa) with coverage and uer: edits between the collapsed classes of text and audio over those of the text; 1 if the text has none."""
    # classes are told once a word of the lexicon, not once a word of the text
    lexicon = one_pronunciation(lexicon, order).withColumn("phones", phone_classes(F.col("phones")))
    expected = collapsed_letters(F.array_join("phones", ""))
    both = lexicon_lookup(df.withColumn("observed", collapsed_ipa_classes(F.col("ipa"))), lexicon).withColumn("expected", expected).drop("phones")
    uer = F.when(F.length("expected") == 0, 1.0).otherwise(string_distance(F.col("expected"), F.col("observed")) / F.greatest(F.length("expected"), F.lit(1)))
    return both.withColumn("uer", uer).drop("expected", "observed")


def eligibility(df: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """df with eligible and comma-joined why; poor coverage hides a text mismatch."""
    seconds = F.col("duration").cast("double")
    rate = phoneme_rate(F.col("n_units"), seconds)
    low = F.col("coverage") < limits.min_coverage
    found = reasons(
        ("duration", ~seconds.between(limits.min_seconds, limits.max_seconds)),
        ("low_coverage", low),
        ("text_audio_mismatch", ~low & (F.col("uer") > limits.max_uer)),
        ("low_snr", F.col("snr_est") < limits.min_snr),
        ("clipping", F.col("clip_frac") > limits.max_clip_frac),
        ("mostly_silence", F.col("silence_frac") > limits.max_silence_frac),
        ("bad_rate", ~rate.between(limits.min_rate, limits.max_rate)),
    )
    return df.withColumn("why", F.concat_ws(",", found)).withColumn("eligible", F.col("why") == "")


_RANK = ("uer", "snr_down", "tie")


def rank_candidates(df: DataFrame, tie: str = "id") -> DataFrame:
    """Eligible rows with the columns that order them: uer up, SNR down, then tie."""
    return df.filter("eligible").withColumn("snr_down", -F.col("snr_est")).withColumn("tie", F.col(tie))


def placed(df: DataFrame, tie: str = "id") -> DataFrame:
    """Eligible rows with place, from 1, among all of them."""
    ranked = prefix_sums(rank_candidates(df, tie), list(_RANK), F.lit(1), "place")
    return ranked.withColumn("place", F.col("place") + 1).drop("snr_down", "tie")


def select_budgeted(df: DataFrame, budget: float, speaker_share: float = 0.08, tie: str = "id", duration: str = "duration", most: int = WALK_ROWS) -> DataFrame:
    """df with selected: best clips first until the budget is reached (it may be passed by one clip), no speaker over its share.

    Whether a clip passes its speaker's cap depends on that speaker's better clips alone, and the budget only cuts the tail. So speakers are walked
    side by side over thin rows (see walk; one with over ``most`` clips on all machines), and the accepted seconds are summed up in ranges of the rank order.
    """
    thin = rank_candidates(df, tie).select("speaker", F.col(duration).cast("double").alias("duration"), "id", *_RANK)
    chosen = budget_cut(within_cap(thin, "speaker", "duration", list(_RANK), speaker_share * budget, most), budget)
    chosen = chosen.select("id", F.lit(True).alias("selected"))
    met = df.filter("eligible").join(chosen, "id", "left").withColumn("selected", F.coalesce("selected", F.lit(False)))
    return met.select(*df.columns, "selected").unionByName(df.filter(~F.coalesce("eligible", F.lit(False))).withColumn("selected", F.lit(False)))  # only eligible rows are moved


def budget_cut(accepted: DataFrame, budget: float) -> DataFrame:
    """Rows whose exclusive prefix sum of duration, in rank order, is under the budget."""
    return prefix_sums(accepted, list(_RANK), F.col("duration"), "start").filter(F.col("start") < budget).drop("start")


def selection_summary(df: DataFrame) -> DataFrame:
    """n, hours, speakers; UER median and p95, SNR median, duration median and mean of the selected rows. Quantiles are exact (see quantiles)."""
    seconds = F.col("duration").cast("double")
    rows = settled(df.filter("selected").select("speaker", "uer", "snr_est", seconds.alias("seconds")))
    found = quantiles(rows, {"uer": (F.col("uer"), (0.5, 0.95)), "snr": (F.col("snr_est"), (0.5,)), "seconds": (F.col("seconds"), (0.5,))})
    return rows.agg(F.count("*").alias("n"), (F.sum("seconds") / 3600).alias("hours"), F.count_distinct("speaker").alias("speakers"), F.avg("seconds").alias("duration_mean")).select(
        "n", "hours", "speakers", number(found["uer", 0.5]).alias("uer_median"), number(found["uer", 0.95]).alias("uer_p95"), number(found["snr", 0.5]).alias("snr_median"),
        number(found["seconds", 0.5]).alias("duration_median"), "duration_mean",
    )
