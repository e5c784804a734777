"""Token counts from an exact length histogram.

Documents are aggregated by encoded length. Suffix sums over the histogram answer, for every context limit, how many
documents are at least so long and how many tokens all documents keep when cut at the limit; shares of the documents give
the quantiles. Only (length, count) rows are shuffled.

Defined cases: null and empty texts have length 0; control strings of the vocabulary inside a text are ordinary text; repeated
rows count each; white space of any length is counted as the split pattern has it (``n_tokens``); an empty table gives an empty histogram and null answers; extra columns are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Split pattern that belongs to this vocabulary (a fixed value, public).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as the split pattern's engine has it; a run of RUN characters is encoded by itself, since the engine's stack ends at some hundred thousand.
RUN = 1 << 14
_LONG = re.compile(f"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{RUN},}}")
#: Lengths in one bucket of the two-level sums.
SPAN = 256


@lru_cache(maxsize=2)
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def n_tokens(encoding, text: str) -> int:
    """Tokens of a text. The pattern takes a run of white space whole at the end of the text and but for its last character elsewhere, so a long one is cut out there and is one piece."""
    n = at = 0
    for run in _LONG.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        n += len(encoding.encode_ordinary(text[at : run.start()])) + len(encoding._encode_single_piece(text[run.start() : end]))
        at = end
    return n + len(encoding.encode_ordinary(text[at:]))


def lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """n_tokens of every row. The vocabulary file lies on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoder(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([n_tokens(encoding, t) if t else 0 for t in b.column(0).to_pylist()], pa.int64())], ["n_tokens"])

    return docs.select("text").mapInArrow(run, "n_tokens long")


def histogram(counted: DataFrame) -> DataFrame:
    return counted.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame, span: int = SPAN) -> DataFrame:
    """For every length in the histogram, taken as a context limit: n_docs, docs_from (at least so long), tokens_from, tokens_cut
    (all documents cut at the limit), docs_to (at most so long) and share_to.

    Sums run inside buckets of ``span`` lengths and over the bucket totals, so no task sorts all lengths. The histogram is kept, so texts are encoded once.
    """
    rows = cut(hist).withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("bucket", F.floor(F.col("n_tokens") / span))
    totals = rows.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above, all_ = W.orderBy(F.desc("bucket")).rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    after = totals.select("bucket", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_after"), F.sum("d").over(all_).alias("d_all"), F.sum("t").over(all_).alias("t_all"))
    down = W.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(W.unboundedPreceding, W.currentRow)
    own = rows.withColumn("d_own", F.sum("n_docs").over(down)).withColumn("t_own", F.sum("tokens").over(down)).join(after, "bucket")
    docs_from, tokens_from = F.col("d_own") + F.col("d_after"), F.col("t_own") + F.col("t_after")
    out = own.select("n_tokens", "n_docs", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"), "d_all", "t_all")
    docs_to = F.col("d_all") - F.col("docs_from") + F.col("n_docs")
    kept = F.col("t_all") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")
    return out.select("n_tokens", "n_docs", "docs_from", "tokens_from", kept.alias("tokens_cut"), docs_to.alias("docs_to"), (docs_to / F.col("d_all")).alias("share_to"))


def answers(hist: DataFrame, limits: list[int], quantiles: list[float]) -> DataFrame:
    """Total tokens, quantiles (smallest length with that share of documents) and the tokens kept at each limit, from the histogram alone."""
    sums = suffix_sums(hist)
    kept = [F.sum(F.least(F.col("n_tokens"), F.lit(x)) * F.col("n_docs")).alias(f"kept_at_{x}") for x in limits]
    marks = [F.min(F.when(F.col("share_to") >= q, F.col("n_tokens"))).alias(f"q{round(q * 100)}") for q in quantiles]
    return sums.agg(F.sum(F.col("n_tokens") * F.col("n_docs")).alias("total_tokens"), F.sum("n_docs").alias("total_docs"), *marks, *kept)
