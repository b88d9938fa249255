"""Token counts by a two-tier lookup: a broadcast table of frequent pre-tokens, and a cache in each worker for the rest.

The subword model never joins characters over a space (no piece has one inside or at its end) nor over a line break
(no piece has one), so a text is the sum of its pre-tokens: a word with the spaces before it, or a word after a line break.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from pointferry.llm.textkit import Kept, documents, id_and_text, small_batches, with_doc_id
from pointferry.operators.sizing import stored

LIMIT = 4096
FREQUENT = 65_536  # rows of the broadcast table, whatever the corpus
OFFERED = 4_096  # rows each task offers for it
CACHED = 200_000  # entries of a generation of a worker's cache, and of a task's counter
LONGEST_KEY = 64
_SPACED = re.compile(r" *[^ ]+| +\Z")
COLUMNS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _path(model: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(model)


def pretokens(text: str) -> list[str]:
    """The parts of a text whose token counts add up to its own.

    A part begins with its spaces but one, which the model puts there itself, or with a line break.
    """
    joined = text.replace("\n", " \n")
    if "  " not in joined and joined[:1] != " ":  # the model puts a space before the text
        return joined.split(" ")
    first, *others = text.split("\n")
    parts = [part[1:] for part in _SPACED.findall(" " + first)]
    for line in others:
        head, *rest = _SPACED.findall("\n" + line)
        parts.append(head)
        parts.extend(part[1:] for part in rest)
    return parts


class Lengths:
    """Token counts of texts: first tier the broadcast table, second tier what this worker has encoded."""

    def __init__(self, model_file: str, frequent: dict[str, int]):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.frequent = frequent
        self.parts = Kept(self._look_up, CACHED)

    def _look_up(self, part: str) -> int:
        n = self.frequent.get(part)
        return self.encoded(part) if n is None else n

    def encoded(self, part: str) -> int:
        """The tokens of a pre-token; before a line break the model puts a space, which is not the text's."""
        if part.startswith("\n"):
            return len(self.model.encode(part)) - 1
        return len(self.model.encode(part)) if part else 1

    def count(self, text: str) -> int:
        if not text:
            return 0
        if "▁" in text or "\0" in text:  # characters the model treats in its own way
            return len(self.model.encode(text))
        return sum(map(self.parts.__getitem__, pretokens(text)))


def frequent_pretokens(docs: DataFrame) -> list[str]:
    """The most frequent pre-tokens of all documents, at most ``FREQUENT`` of them.

    Each task counts in bounded memory and offers its most frequent ones; pre-tokens themselves are
    never shuffled. The choice only changes speed, never a count.
    """

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in (part for whole in batches for part in small_batches(whole)):
            for text in batch.column("text").to_pylist():
                counts.update(pretokens(text))
                least = 1
                while len(counts) > CACHED:
                    counts = Counter({k: v for k, v in counts.items() if v > least})
                    least *= 2
        top = [(k, v) for k, v in counts.most_common(OFFERED) if len(k) <= LONGEST_KEY]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()), pa.array([v for _, v in top], pa.int64())], names=["part", "n"])

    offered = docs.select("text").mapInArrow(offer, "part string, n long")
    top = offered.groupBy("part").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "part").limit(FREQUENT)
    return [r["part"] for r in stored(top.select("part"), "frequent-pretokens").collect()]  # merged by a task, not by the driver


def count_tokens(df: DataFrame, model: str = "piece_bpe_32k.model", limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its bytes, its tokens, and whether they exceed the limit.

    A null or empty text has no tokens. Repeated rows give repeated results. Very long texts are
    counted whole. There is no shuffle of texts or pre-tokens.
    """
    docs = id_and_text(df, id_col, text_col)
    lengths = Lengths(_path(model), {})
    table = docs.sparkSession.sparkContext.broadcast({part: lengths.encoded(part) for part in frequent_pretokens(docs)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(_path(model), table.value)
        for batch in (part for whole in batches for part in small_batches(whole)):
            texts = batch.column("text")
            n = pa.array([lengths.count(t) for t in texts.to_pylist()], pa.int64())
            size = pc.cast(pc.binary_length(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, n, pc.greater(n, limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return with_doc_id(docs.mapInArrow(run, COLUMNS), id_col)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return count_tokens(documents(spark, sf_dir))


ENTRIES = {"op5_token_counts": (op5_token_counts, None)}
