"""Packing: concatenate all documents' tokens and cut them into fixed windows."""

from __future__ import annotations

import re
import sys
import types
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daymetrics.llm.common import stored

#: Words, and parts of words, whose ids a Python worker remembers; then it starts anew. About 250
#: bytes each.
REMEMBERED = 600_000
#: Words without an apostrophe, of ASCII and of Latin letters that have one code point in every form.
_PLAIN = re.compile(r"[!-&(-~À-ÖØ-Þß-öø-ÿ]+")
_PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-/:-`{-~]+")
#: Python counts these as blanks, the tokenizer doesn't.
_ODD_BLANKS = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes are themselves, the others follow from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in printable]
    return {b: chr(b) if b in printable else chr(256 + hidden.index(b)) for b in range(256)}


class Remembered(dict):
    """Ids by word or part, made by a function on the first look-up; bounded by starting anew."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[key] = self.make(key)
        return ids


class WordEncoder:
    """Ids of whole texts under a tokenizer that splits at blanks and has no context across them.

    A word's ids are computed once and remembered, for as long as the worker lives. `by_words`
    says whether the tokenizer is of the kind that this holds for (lower case after NFC, blanks
    dropped, byte-level BPE with word ends); others encode each text as one.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.type, self.code = np.dtype("<u4" if wide else "<u2"), "I" if wide else "H"
        model, pre, normal = self.tokenizer.model, self.tokenizer.pre_tokenizer, repr(self.tokenizer.normalizer)
        self.by_words = (
            type(model).__name__ == "BPE"
            and model.end_of_word_suffix == "</w>"
            and model.dropout is None
            and all(x in normal for x in ("NFC()", r"\s+", "Lowercase()"))
            and r"[^\s\p{L}\p{N}]+" in repr(pre)
            and "ByteLevel" in repr(pre)
        )
        self.model = model
        self.letters = _byte_letters()
        self.parts = Remembered(self.part)
        self.words = Remembered(self.word)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type)

    def part(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(part)]).tobytes()

    def word(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word) or "<|" in word:
            return self.whole(word).tobytes()
        return b"".join(map(self.parts.__getitem__, _PARTS.findall(word.lower())))

    def encode(self, text: str) -> bytes:
        if not self.by_words or _ODD_BLANKS.search(text):
            return self.whole(text).tobytes()
        return b"".join(map(self.words.__getitem__, text.split()))


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for this file. Worker processes serve many tasks: it outlives one."""
    kept = sys.modules.setdefault("_daymetrics_encoders", types.ModuleType("_daymetrics_encoders"))
    if path not in kept.__dict__:
        kept.__dict__[path] = WordEncoder(path)
    return kept.__dict__[path]


def tokenised(
    documents: DataFrame, tokenizer_path: str, end_id: int | None, row_id: str, text: str
) -> tuple[DataFrame, int]:
    """First pass: every document's ids, stored, with its place in the task that read it.

    Columns: id, ids (little-endian unsigned numbers of the returned width), n, part (the task),
    before (tokens that the task has seen before this document).
    """
    type_ = WordEncoder(tokenizer_path).type
    end = b"" if end_id is None else np.array([end_id], type_).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded, before, part = encoder(tokenizer_path), 0, TaskContext.get().partitionId()
        for batch in batches:
            ids = [encoded.encode(t.as_py() or "") + end for t in batch.column(1)]
            n = [len(x) // type_.itemsize for x in ids]
            places = list(accumulate(n, initial=before))
            before = places.pop()
            columns = [batch.column(0), pa.array(ids, pa.binary()), n, [part] * len(n), places]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns],
                ["id", "ids", "n", "part", "before"],
            )

    frame = documents.select(F.col(row_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return stored(frame.mapInArrow(encode, "id long, ids binary, n long, part long, before long")), type_.itemsize


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    window: int = 2048,
    end_id: int | None = 1,
    row_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The pieces of all documents' token sequences in windows of `window` tokens.

    Every document (null text: empty) is its ids and then `end_id`; documents follow each other
    in the order of the stored token table and are cut wherever a window ends. All sequences are
    full but the last. Columns: `row_id`, start and length (in the document), ids (little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset (in the sequence), opens and closes
    (whether the document begins or ends here: the boundary records).

    Two passes: the first tokenises and sums up the tokens of each task; prefix sums over these
    totals, one number a task, give every task its global offset; the second cuts, without a
    shuffle. The token table is written once, so offsets stay the same when executors are lost.
    Repeated rows are packed as often as they occur; without `end_id` an empty document has no
    piece; an empty table gives an empty one; other columns are not looked at.
    """
    tokens, width = tokenised(documents, tokenizer_path, end_id, row_id, text)
    totals = sorted(tokens.groupBy("part").agg(F.sum("n").alias("n")).collect())
    bases = dict(zip((r["part"] for r in totals), accumulate((r["n"] for r in totals), initial=0), strict=False))
    names = [row_id, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, part, before = (batch.column(c) for c in range(1, 5))
            n, before = np.asarray(n), np.asarray(before)
            first = np.array([bases[p] for p in part.to_pylist()], np.int64) + before
            # Number of windows that a document touches, and each piece's document.
            pieces = np.where(n > 0, (first + n - 1) // window - first // window + 1, 0)
            doc = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[doc] // window + nth
            start = np.maximum(sequence * window - first[doc], 0)
            end = np.minimum((sequence + 1) * window - first[doc], n[doc])
            texts = [ids[i].as_buffer() for i in range(len(n))]
            cuts = [
                np.frombuffer(texts[d], f"<u{width}", e - s, s * width).astype("<u4").tobytes()
                for d, s, e in zip(doc.tolist(), start.tolist(), end.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(doc)),
                    *map(pa.array, (start, end - start)),
                    pa.array(cuts, pa.binary()),
                    *map(pa.array, (n[doc], sequence, first[doc] + start - sequence * window)),
                ],
                names,
            )

    made = tokens.mapInArrow(
        cut, f"`{row_id}` long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    ends = (F.col("start") + F.col("length")) == F.col("doc_tokens")
    return made.withColumns({"opens": F.col("start") == 0, "closes": ends})
