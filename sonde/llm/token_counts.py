"""Token counts from pre-token frequencies.

A sentencepiece BPE model whose pieces never hold a space after another character cannot merge across the
start of a space run, so a text's pieces are the pieces of its pre-tokens. Each batch's distinct pre-tokens
are counted once by the library; a document's count is the sum over its pre-token frequencies. Ids are never
built for a document, nothing is shuffled, and the memory of counts is bounded by `memory` entries.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.common import bounded_batches

MEMORY = 300_000
LIMIT = 4096
SPACE = "▁"


class PieceCounter:
    """Counts of one sentencepiece model, remembered by pre-token."""

    def __init__(self, model: str, memory: int = MEMORY) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.memory = memory
        #: A last single space is a pre-token of its own, and the library gives nothing for what is left of it.
        self.alone = {"": len(self.library.encode("\n ")) - len(self.library.encode("\n"))}
        self.known: dict[str, int] = dict(self.alone)
        self.separable = self._separable(model)

    def _separable(self, model: str) -> bool:
        """Whether no merge crosses into a space run and the text reaches the model unchanged."""
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        with open(model, "rb") as f:
            spec.ParseFromString(f.read())
        plain = spec.normalizer_spec.name == "identity" and not spec.normalizer_spec.precompiled_charsmap
        kept = spec.normalizer_spec.add_dummy_prefix and not spec.normalizer_spec.remove_extra_whitespaces and spec.normalizer_spec.escape_whitespaces
        bpe = spec.trainer_spec.model_type == 2 and not spec.trainer_spec.treat_whitespace_as_suffix
        inside = any(SPACE in p.piece.lstrip(SPACE) for p in spec.pieces)
        own = any(p.type == 4 for p in spec.pieces)  # user-defined symbols are cut out before merging
        return plain and kept and bpe and not inside and not own

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens, each without the one space that the library puts in front of what it is given."""
        if SPACE in text:  # the library's own mark is the same as a space
            text = text.replace(SPACE, " ")
        parts = text.split(" ") if text else []
        if "" not in parts:
            return parts
        out, blanks = [], 0
        for part in parts[:-1]:
            if part:
                out.append(" " * blanks + part)
                blanks = 0
            else:
                blanks += 1
        out.append(" " * blanks + parts[-1])
        return out

    def counts(self, texts: list[str]) -> list[int]:
        if not self.separable:
            return [len(self.library.encode(t)) for t in texts]
        frequencies = [Counter(self.pre_tokens(t)) for t in texts]
        new = list({w for f in frequencies for w in f if w not in self.known})
        if len(self.known) + len(new) > self.memory:
            self.known = dict(self.alone)
            new = list({w for f in frequencies for w in f if w})
        step = 50_000
        for i in range(0, len(new), step):
            part = new[i : i + step]
            self.known.update(zip(part, map(len, self.library.encode(part, num_threads=1)), strict=True))
        known = self.known
        return [sum([known[w] * n for w, n in f.items()]) for f in frequencies]


def token_counts(docs: DataFrame, model: str | None = None, limit: int = LIMIT, text: str = "text", keep: tuple[str, ...] = ("doc_id",), memory: int = MEMORY) -> DataFrame:
    """Rows (*keep, n_bytes, n_tokens, over_limit), one for each row of `docs`.

    `model`: path of the sentencepiece model on every machine; default the public 32k one. Null and empty texts
    have 0 bytes and 0 tokens. Repeated rows and null ids each give their own row; other columns are not read.
    An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = model
        if path is None:
            import public_tokenizers

            path = str(public_tokenizers.path("piece_bpe_32k.model"))
        counter = PieceCounter(path, memory)
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            n = counter.counts(texts)
            size = batch.column(len(keep) + 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], size, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=[*keep, "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(*keep, F.col(text).alias("__text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("__bytes"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.select(*keep).dtypes)
    return rows.mapInArrow(run, f"{kinds}, n_bytes long, n_tokens long, over_limit boolean")
