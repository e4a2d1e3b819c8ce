"""Encoding of texts with a public byte-level BPE tokenizer (problem 8).

Each task keeps one in-memory DuckDB with the tokenizer's merge table. The distinct words of a slice of texts become
token-position rows; a recursive query joins neighbouring tokens with the merge table and contracts, in each word, the
pair of minimum rank from the left, until no word has a pair left. The step number makes every row of a word that
changed count as new. A pair that occurs several times in a word is
contracted at all its places in one step, from the left and without overlap: merges that use the new token rank behind
the one that made it, so this is what contracting one place at a time comes to.

A long word would need as many steps as it has different merges, each over all of it. It is cut into chunks that are
encoded like words, and neighbouring chunks are joined pairwise: ids are those of their text if and only if every two
neighbours among them are the ids of theirs, so that only the seams are looked at, and a window around a seam that doesn't
hold is encoded anew, wider until its ends hold.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.session import spread, tokenizer_dir

#: Fixed value: the public pattern that cuts a text into words before byte-level BPE.
WORDS = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Bytes of texts handled at once, bytes of new words given to one query, and words kept between slices.
SLICE_BYTES, QUERY_BYTES, KEEP_WORDS = 2 << 20, 256 << 10, 150_000
#: Words of more bytes are cut into chunks of so many; tokens on either side of a seam that are encoded anew first.
CHUNK_BYTES, SEAM_TOKENS = 400, 8

_CONTRACT = """
with recursive t(word, pos, tok, step) using key (word, pos) as (
  select word, pos, tok, 0 from start
  union
  (
    with seq as (
      select word, pos, tok, step, row_number() over w as i, lead(tok) over w as nxt
      from t where tok >= 0 window w as (partition by word order by pos)
    ), pair as (
      select s.word, s.i, m.rank, m.merged, min(m.rank) over (partition by s.word) as least
      from seq s join merge m on m.l = s.tok and m.r = s.nxt
    ), place as (
      select word, i, merged, i - row_number() over (partition by word order by i) as run from pair where rank = least
    ), chosen as (
      select word, i, merged from (select *, row_number() over (partition by word, run order by i) as k from place) where k % 2 = 1
    )
    select s.word, s.pos, case when b.i is not null then -1 else coalesce(a.merged, s.tok) end, s.step + 1
    from seq s
    semi join chosen w on w.word = s.word
    left join chosen a on a.word = s.word and a.i = s.i
    left join chosen b on b.word = s.word and b.i = s.i - 1
  )
)
select word, list(tok order by pos) as ids from t where tok >= 0 group by word order by word
"""


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary files of byte-level BPE: printable Latin-1
    stands for itself, the other bytes take the characters from 256 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Tokenizer:
    """A byte-level BPE vocabulary with its merge table in an in-memory DuckDB, one thread, nothing on disk."""

    def __init__(self, folder: str, name: str = "byte_bpe_50k"):
        import duckdb

        with open(os.path.join(folder, f"{name}.json"), encoding="utf-8") as source:
            model = json.load(source)["model"]
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.byte_ids = np.array([vocab[c] for c in byte_symbols()], dtype=np.int32)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        merge = pa.table(
            {
                "l": pa.array([vocab[a] for a, _ in pairs], pa.int32()),
                "r": pa.array([vocab[b] for _, b in pairs], pa.int32()),
                "rank": pa.array(range(len(pairs)), pa.int32()),
                "merged": pa.array([vocab[a + b] for a, b in pairs], pa.int32()),
            }
        )
        self.db.execute("create table merge as select * from merge")
        back = {c: b for b, c in enumerate(byte_symbols())}
        tokens = [(i, bytes(back[c] for c in s)) for s, i in vocab.items() if all(c in back for c in s)]
        token = pa.table({"id": pa.array([i for i, _ in tokens], pa.int32()), "hex": pa.array([b.hex() for _, b in tokens])})
        self.db.execute("create table token as select * from token")
        self.token_bytes = dict(tokens)
        self.known: dict[str, list[int]] = {}
        self.pieces: dict[bytes, list[int]] = {}

    def _contract(self, words: list[bytes]) -> None:
        lengths = np.array([len(b) for b in words])
        first = np.cumsum(lengths) - lengths
        start = pa.table(
            {
                "word": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
                "pos": (np.arange(lengths.sum()) - np.repeat(first, lengths)).astype(np.int32),
                "tok": self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)],
            }
        )
        self.db.register("start", start)
        found = self.db.sql(_CONTRACT).to_arrow_table()
        self.db.unregister("start")
        for word, ids in zip(found["word"].to_pylist(), found["ids"].to_pylist()):
            self.pieces[words[word]] = ids

    def _learn_pieces(self, pieces: Iterable[bytes]) -> None:
        """Encodes the pieces that aren't known yet, a bounded number of bytes at a time."""
        part, held = [], 0
        for piece in dict.fromkeys(pieces):
            if piece in self.pieces:
                continue
            part.append(piece)
            held += len(piece)
            if held > QUERY_BYTES:
                self._contract(part)
                part, held = [], 0
        if part:
            self._contract(part)

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join(self.token_bytes[i] for i in ids)

    def _joined(self, pairs: list[tuple[list[int], list[int]]]) -> list[list[int]]:
        """The ids of the text of each two neighbouring runs of ids, each of which is right on its own."""
        out: list[list[int] | None] = [None] * len(pairs)
        width = dict.fromkeys(range(len(pairs)), 0)
        while width:
            windows = {i: (pairs[i][0][-k:] if k else [], pairs[i][1][:k]) for i, k in width.items()}
            anew = {i: self._bytes(a + b) for i, (a, b) in windows.items() if width[i]}
            self._learn_pieces(anew.values())
            tried, seams = {}, {}
            for i, k in width.items():
                a, b = pairs[i]
                head, middle, tail = (a[:-k], self.pieces[anew[i]], b[k:]) if k else (a, [], b)
                tried[i] = head + middle + tail
                ends = [head[-1:] + middle[:1], middle[-1:] + tail[:1]] if k else [head[-1:] + tail[:1]]
                seams[i] = [e for e in ends if len(e) == 2]
            self._learn_pieces(self._bytes(e) for ends in seams.values() for e in ends)
            for i in list(width):
                if all(self.pieces[self._bytes(e)] == e for e in seams[i]):
                    out[i] = tried[i]
                    del width[i]
                else:
                    width[i] = max(SEAM_TOKENS, 2 * width[i])
        return out

    def _long(self, word: bytes) -> list[int]:
        chunks = [word[i : i + CHUNK_BYTES] for i in range(0, len(word), CHUNK_BYTES)]
        self._learn_pieces(chunks)
        runs = [self.pieces[c] for c in chunks]
        while len(runs) > 1:
            joined = self._joined(list(zip(runs[::2], runs[1::2])))
            runs = joined + (runs[-1:] if len(runs) % 2 else [])
        return runs[0]

    def learn(self, words: set[str]) -> None:
        """Encodes the words that aren't known yet."""
        if len(self.known) > KEEP_WORDS:
            self.known.clear()
        if len(self.pieces) > KEEP_WORDS:
            self.pieces.clear()
        data = {w: w.encode("utf-8", "surrogatepass") for w in words if w not in self.known}
        self._learn_pieces(b for b in data.values() if len(b) <= CHUNK_BYTES)
        for word, b in data.items():
            self.known[word] = self.pieces[b] if len(b) <= CHUNK_BYTES else self._long(b)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text, without special tokens, whose strings are ordinary text; null and '' give []."""
        split = [WORDS.findall(t) if t else [] for t in texts]
        self.learn({w for words in split for w in words})
        known = self.known
        return [[i for w in words for i in known[w]] for words in split]

    def decode(self, lists: list[list[int]]) -> list[str]:
        """Texts of id lists by an ordered aggregation over token-position rows; the inverse of ``encode``."""
        lengths = [len(x) for x in lists]
        rows = pa.table(
            {
                "doc": np.repeat(np.arange(len(lists), dtype=np.int32), lengths),
                "pos": np.concatenate([np.arange(n, dtype=np.int32) for n in lengths] or [np.zeros(0, np.int32)]),
                "id": pa.array([i for x in lists for i in x], pa.int32()),
            }
        )
        self.db.register("ids", rows)
        found = self.db.execute("select doc, string_agg(hex, '' order by pos) as hex from ids join token using (id) group by doc").fetchall()
        self.db.unregister("ids")
        out = [""] * len(lists)
        for doc, text in found:
            out[doc] = bytes.fromhex(text).decode("utf-8", "replace")
        return out


_OPEN: dict[tuple[str, str], Tokenizer] = {}


def tokenizer(folder: str, name: str) -> Tokenizer:
    """The tokenizer of this Python process, opened once."""
    if (folder, name) not in _OPEN:
        _OPEN[folder, name] = Tokenizer(folder, name)
    return _OPEN[folder, name]


def slices(texts: list[str | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts with about ``limit`` characters each, at least one text in a run."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t) if t else 0
        if held > limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def token_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """One row per document: ``id_col`` and ``ids``, the token ids of the whole text.

    Null, empty texts give an empty list; blank texts have tokens like any other. Ids, null or repeated, are passed
    through, one row for each input row; other columns are not read. No rows give no rows. Nothing is shuffled unless the
    scan has fewer splits than there are cores.
    """
    where = tokenizer_dir(folder)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(where, name)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                ids = own.encode(texts[a:b])
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = pa.array(np.fromiter((i for x in ids for i in x), dtype=np.int32, count=offsets[-1]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(offsets, flat)], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return spread(docs.select(id_col, F.col(text_col).cast("string").alias("text"))).mapInArrow(encode, f"`{id_col}` {kind}, ids array<int>")


def texts_of(encoded: DataFrame, id_col: str = "doc_id", name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """Decodes ``ids`` back: ``id_col`` and ``text``. A null or empty list gives ''."""
    where = tokenizer_dir(folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(where, name)
        for batch in batches:
            lists = [x or [] for x in batch.column(1).to_pylist()]
            for a in range(0, len(lists), 500):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, 500), pa.array(own.decode(lists[a : a + 500]), pa.string())], names=[id_col, "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(decode, f"`{id_col}` {kind}, text string")
