"""SentencePiece encoding and decoding through tables of distinct chunks.

No piece of the model holds the white space marker after another character
(checked when the model is loaded), so no merge joins two chunks of the form
``marker+ other*`` and each chunk has the same pieces wherever it stands. A
task segments each distinct chunk once and joins the ids back by position.

The table of distinct chunks lives in the task. A table of the whole corpus
would send every occurrence with its position through a shuffle twice; that is
several times the input. The table is cleared when its chunks reach a set
number of characters, so memory is bounded by that and by one batch of texts.

Null texts count as empty: no ids, empty text. Rows keep their order and number;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.llm.common import keyed, shared_model, unkeyed

MARK = "▁"
TABLE_CHARS = 4_000_000
PART_CHARS = 1_000_000
RUN_CHUNKS = 64
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class ChunkTable:
    """What the model does with distinct chunks, kept for the task."""

    def __init__(self, model: bytes, limit: int = TABLE_CHARS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece crosses a white space marker; chunks are not independent")
        self.numbers = [str(i) for i in range(n)]
        self.heads = [p.startswith(MARK) for p in pieces]
        self.limit = limit
        self.chars, self.ids, self.odd, self.texts = 0, {}, {}, {}

    def chunks(self, text: str) -> list[str]:
        """The normalised text cut before every run of markers; a chunk's marker run stands at its head."""
        marked = self.model.normalize(text)
        found = _CHUNK.findall(marked)
        if sum(map(len, found)) != len(marked):  # a model that adds no marker at the head
            raise ValueError("the normalised text does not begin with a marker")
        return found

    def learn(self, chunks: set[str]) -> None:
        """Segment and spell the chunks that the table lacks.

        Chunks with one marker go through the model in runs, each as one text: a
        piece with a marker begins the next chunk. The others go one by one.
        """
        if self.chars > self.limit:
            self.chars, self.ids, self.odd, self.texts = 0, {}, {}, {}
        new = [c for c in chunks if c not in self.ids]
        self.chars += sum(map(len, new))
        plain = [c for c in new if c[1:2] != MARK and len(c) > 1]
        runs = [plain[k : k + RUN_CHUNKS] for k in range(0, len(plain), RUN_CHUNKS)]
        texts = ["".join(r).replace(MARK, " ")[1:] for r in runs]
        coded = self.model.encode(texts, num_threads=1)
        for run, text, ids, back in zip(runs, texts, coded, self.model.decode(coded), strict=True):
            starts = [k for k, i in enumerate(ids) if self.heads[i]]
            if len(starts) == len(run) and back == text:
                names = [self.numbers[i] for i in ids]
                for chunk, lo, hi in zip(run, starts, [*starts[1:], len(names)], strict=True):
                    self.ids[chunk] = ",".join(names[lo:hi])
        new = [c for c in new if c not in self.ids]
        # The model puts a marker before what it is given, so a chunk goes in without its first one.
        for chunk, ids in zip(new, self.model.encode([c[1:].replace(MARK, " ") for c in new], num_threads=1), strict=True):
            if chunk == MARK:  # the library gives no piece for an empty text
                ids = [self.model.piece_to_id(MARK)]
            self.ids[chunk] = ",".join(map(str, ids))
            text = " " + self.model.decode(ids)
            if text != chunk.replace(MARK, " "):
                self.odd[chunk] = text

    def spell(self, keys: set[str]) -> None:
        """The text behind each key, a chunk's ids joined by commas; its first marker is a blank."""
        new = [k for k in keys if k not in self.texts]
        for key, text in zip(new, self.model.decode([[int(x) for x in k.split(",")] for k in new]), strict=True):
            self.texts[key] = " " + text
            self.chars += len(key)

    def text_of(self, chunks: list[str]) -> str:
        """The decoded text of learned chunks; the head's marker is not a blank."""
        if self.odd:
            chunks = [self.odd.get(c, c) for c in chunks]
        return "".join(chunks).replace(MARK, " ")[1:]


def parts(texts: list[str], limit: int = PART_CHARS) -> Iterator[slice]:
    """Stretches of texts of at most so many characters, or of one text: chunks take many times a text's bytes."""
    lo, held = 0, 0
    for k, text in enumerate(texts):
        if k > lo and held + len(text) > limit:
            yield slice(lo, k)
            lo, held = k, 0
        held += len(text)
    if lo < len(texts):
        yield slice(lo, len(texts))


_TABLES: dict[tuple[int, int], ChunkTable] = {}


def _table(model: bytes, limit: int) -> ChunkTable:
    """One table for each worker process and model, reused by its later tasks."""
    key = (hash(model), limit)
    if key not in _TABLES:
        _TABLES[key] = ChunkTable(model, limit)
    return _TABLES[key]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = TABLE_CHARS) -> DataFrame:
    """Per document the id and ``chunk_ids``: for each chunk in order its ids joined by commas."""
    model = shared_model(docs, model_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _table(model.value, limit)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            for part in parts(texts):
                cut = [table.chunks(t) if t else [] for t in texts[part]]
                table.learn(set().union(*cut))
                get = table.ids.__getitem__
                yield pd.DataFrame({"id": batch["id"].iloc[part], "chunk_ids": [list(map(get, c)) for c in cut]})

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("chunk_ids", T.ArrayType(T.StringType()))])
    return unkeyed(keyed(docs, id_col, text=text_col).mapInPandas(run, schema), docs, id_col)


def with_ids(encoded: DataFrame) -> DataFrame:
    """Adds ``ids``, all ids as an array of int."""
    return encoded.withColumn("ids", F.flatten(F.transform("chunk_ids", lambda c: F.split(c, ",").cast("array<int>"))))


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", limit: int = TABLE_CHARS) -> DataFrame:
    """The text behind ``chunk_ids``, each distinct chunk spelled once; a marker at the head is not a blank."""
    model = shared_model(encoded, model_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _table(model.value, limit)
        for batch in batches:
            rows = [list(r) if r is not None else [] for r in batch["chunk_ids"]]
            table.spell(set().union(*rows))
            get = table.texts.__getitem__
            yield pd.DataFrame({"id": batch["id"], "decoded": ["".join(map(get, r))[1:] for r in rows]})

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("decoded", T.StringType())])
    return unkeyed(keyed(encoded, id_col, chunk_ids="chunk_ids").mapInPandas(run, schema), encoded, id_col)


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = TABLE_CHARS) -> DataFrame:
    """Encode and decode in one pass: id, n_tokens, ids_sha256, decoded_sha256, same_text.

    The digests are of the decimal ids joined by commas and of the decoded
    text in UTF-8; ``same_text`` tells whether decoding gave the text back.
    """
    model = shared_model(docs, model_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _table(model.value, limit)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            out = []
            texts = [t or "" for t in batch["text"]]
            for part in parts(texts):
                cut = [table.chunks(t) for t in texts[part]]
                table.learn(set().union(*cut))
                get = table.ids.__getitem__
                for text, chunks in zip(texts[part], cut, strict=True):
                    joined, back = ",".join(map(get, chunks)), table.text_of(chunks)
                    out.append((joined.count(",") + 1 if joined else 0, sha(joined), sha(back), back == text))
            yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256", "same_text"]).assign(id=batch["id"].values)

    schema = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
            T.StructField("same_text", T.BooleanType()),
        ]
    )
    return unkeyed(keyed(docs, id_col, text=text_col).mapInPandas(run, schema), docs, id_col)
