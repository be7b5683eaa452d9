"""Encoding of whole texts with a public byte-level BPE tokenizer, by recursive queries in each partition."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder of the vocabulary files; a parameter of every operator here.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: DuckDB in a worker: one thread, in memory only, nothing on local disks.
DUCKDB = {"threads": 1, "memory_limit": "500MB", "max_temp_directory_size": "0B"}
#: Chunks of text, and stretches of bytes, whose ids a worker process remembers; beyond that it begins anew.
REMEMBERED = 200_000

CONTRACT = """
WITH RECURSIVE
step(round, word, pos, tok) AS (
  SELECT 0, word, pos, tok FROM stretches
  UNION ALL
  SELECT round + 1, word, pos, CASE WHEN hit THEN new ELSE tok END
  FROM (
    SELECT *, lag(hit, 1, false) OVER (PARTITION BY word ORDER BY pos) AS eaten
    FROM (
      SELECT *, is_least AND (tok <> next OR (place - coalesce(max(CASE WHEN NOT is_least THEN place END) OVER (PARTITION BY word ORDER BY pos), 0)) % 2 = 1) AS hit
      FROM (
        SELECT *, coalesce(rank = min(rank) OVER (PARTITION BY word), false) AS is_least, min(rank) OVER (PARTITION BY word) IS NOT NULL AS open
        FROM (
          SELECT round, word, pos, tok, lead(tok) OVER w AS next, row_number() OVER w AS place
          FROM step WINDOW w AS (PARTITION BY word ORDER BY pos)
        ) LEFT JOIN merges ON merges.l = tok AND merges.r = next
      ) WHERE open
    )
  ) WHERE NOT eaten
)
SELECT word, list(tok ORDER BY pos) AS ids
FROM (SELECT *, max(round) OVER (PARTITION BY word) AS last FROM step) WHERE round = last GROUP BY word ORDER BY word
"""


#: The ids' pieces put together again in their order, still in the byte-level alphabet.
JOINED = "SELECT word, string_agg(piece, '' ORDER BY pos) AS text FROM given_ids JOIN pieces USING (tok) GROUP BY word ORDER BY word"


@lru_cache(maxsize=4)
def vocabulary(path: str) -> dict[str, np.ndarray]:
    """The vocabulary file's ids of the 256 bytes and its merges (l, r, rank, new), and which pairs of bytes can meet
    inside a token: those that some merge joins."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    sign = alphabet()
    byte = {c: b for b, c in sign.items()}
    meet = np.zeros((256, 256), dtype=bool)
    for a, b in merges:
        meet[byte[a[-1]], byte[b[0]]] = True
    num = lambda x: np.array(list(x), dtype=np.int32)
    return {"bytes": num(ids[sign[b]] for b in range(256)), "l": num(ids[a] for a, _ in merges), "r": num(ids[b] for _, b in merges), "new": num(ids[a + b] for a, b in merges), "meet": meet}


def alphabet() -> dict[int, str]:
    """The sign of each byte in the vocabulary: printable bytes stand for themselves, the others for code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}


@lru_cache(maxsize=4)
def pieces(path: str) -> list[str | None]:
    """The piece of each id, in signs; None for ids without one."""
    with open(path, encoding="utf-8") as f:
        ids = json.load(f)["model"]["vocab"]
    out: list[str | None] = [None] * (max(ids.values()) + 1)
    for piece, i in ids.items():
        out[i] = piece
    return out


class Encoder:
    """Texts to ids, in one worker process. Texts are cut where no token can span, so that equal chunks are encoded
    once: at spaces into chunks, by the pattern into words, and at pairs of bytes that no merge joins into stretches.
    New stretches go to DuckDB, whose recursive query contracts each one's pairs of least rank, leftmost first,
    until none is left."""

    def __init__(self, vocab: dict[str, np.ndarray]):
        import duckdb
        import regex

        self.vocab, self.find = vocab, regex.compile(PATTERN).findall
        self.db = duckdb.connect(config=DUCKDB)
        merges = pa.table({"l": vocab["l"], "r": vocab["r"], "rank": np.arange(len(vocab["l"]), dtype=np.int32), "new": vocab["new"]})
        self.db.register("given", merges)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.chunks: dict[str, np.ndarray] = {}
        self.known: dict[bytes, list[int]] = {}

    def contract(self, new: list[bytes]) -> None:
        """Ids of byte stretches, which it remembers."""
        one = [s for s in new if len(s) == 1]
        self.known.update((s, [int(self.vocab["bytes"][s[0]])]) for s in one)
        new = [s for s in new if len(s) > 1]
        if not new:
            return
        lens = np.array([len(s) for s in new])
        flat = self.vocab["bytes"][np.frombuffer(b"".join(new), dtype=np.uint8)]
        word = np.repeat(np.arange(len(new), dtype=np.int64), lens)
        pos = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
        self.db.register("stretches", pa.table({"word": word, "pos": pos, "tok": flat}))
        ids = self.db.execute(CONTRACT).to_arrow_table().column("ids").to_pylist()
        self.known.update(zip(new, ids))

    def learn(self, chunks: list[str]) -> None:
        """Ids of chunks, which it remembers."""
        words = {w: None for c in chunks for w in self.find(c)}
        meet, cuts = self.vocab["meet"], {}
        for w in words:
            b = w.encode("utf-8", "replace")
            x = np.frombuffer(b, dtype=np.uint8)
            at = [0, *(np.flatnonzero(~meet[x[:-1], x[1:]]) + 1).tolist(), len(b)]
            cuts[w] = [b[p:q] for p, q in zip(at, at[1:])]
        self.contract(list({s: None for ss in cuts.values() for s in ss if s not in self.known}))
        ids = {w: [i for s in ss for i in self.known[s]] for w, ss in cuts.items()}
        for c in chunks:
            self.chunks[c] = np.array([i for w in self.find(c) for i in ids[w]], dtype=np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of all texts; null gives none."""
        if len(self.chunks) > REMEMBERED:
            self.chunks = {}
        if len(self.known) > REMEMBERED:
            self.known = {}
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.split_pattern(texts, " ")
        pieces, bounds = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
        first = np.zeros(len(pieces), dtype=bool)
        first[bounds[:-1]] = True
        start = first | ~_may_join(pieces)  # other pieces begin with white space and stay with the chunk before
        begins = np.flatnonzero(start)
        ends = np.append(begins[1:], len(pieces))
        single = ends - begins == 1
        coded = pieces.dictionary_encode()
        code = coded.indices.to_numpy()
        key = np.where(single, code[begins] * 2 + first[begins], -1)
        distinct, of = np.unique(key, return_inverse=True)
        words = coded.dictionary
        names = [None if k < 0 else ("" if k & 1 else " ") + words[int(k) >> 1].as_py() for k in distinct.tolist()]
        longer: dict[str, int] = {}
        for g in np.flatnonzero(~single).tolist():
            a, b = int(begins[g]), int(ends[g])
            name = ("" if first[a] else " ") + " ".join(pieces[a:b].to_pylist())
            of[g] = len(names) + longer.setdefault(name, len(longer))
        names += longer
        self.learn([x for x in names if x is not None and x not in self.chunks])
        ids = [np.empty(0, np.int32) if x is None else self.chunks[x] for x in names]
        lens = np.array([len(x) for x in ids], dtype=np.int64)
        flat, starts = np.concatenate(ids) if ids else np.empty(0, np.int32), np.cumsum(lens) - lens
        many = lens[of]
        upto = np.append(0, np.cumsum(many))
        take = np.repeat(starts[of] - upto[:-1], many) + np.arange(upto[-1])
        groups = np.searchsorted(begins, bounds)
        return upto[groups], flat[take]


def _may_join(pieces: pa.Array) -> np.ndarray:
    """Whether a piece is empty or begins with white space, so that a run of white space may go on into it."""
    off = np.frombuffer(pieces.buffers()[1], dtype=np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    raw = np.frombuffer(pieces.buffers()[2], dtype=np.uint8) if pieces.buffers()[2] is not None else np.empty(0, np.uint8)
    raw = np.append(raw, np.zeros(3, np.uint8))
    a, b, c = (raw[np.minimum(off[:-1] + i, len(raw) - 1)] for i in range(3))
    wide = ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    wide |= (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    return (off[1:] == off[:-1]) | ((a >= 9) & (a <= 13)) | ((a >= 28) & (a <= 31)) | wide


class Decoder:
    """Ids to texts, in one worker process: a query in DuckDB joins the ids with their pieces and aggregates these in order."""

    def __init__(self, pieces: list[str], alphabet: dict[str, int]):
        import duckdb

        self.bytes, self.db = str.maketrans(alphabet), duckdb.connect(config=DUCKDB)
        self.db.register("given", pa.table({"tok": pa.array(range(len(pieces)), pa.int32()), "piece": pa.array(pieces, pa.string())}))
        self.db.execute("CREATE TABLE pieces AS SELECT * FROM given WHERE piece IS NOT NULL")

    def decode(self, ids: pa.Array) -> list[str]:
        lens = pc.fill_null(ids.value_lengths(), 0).to_numpy(zero_copy_only=False)
        word = np.repeat(np.arange(len(ids), dtype=np.int64), lens)
        pos = np.arange(len(word)) - np.repeat(np.cumsum(lens) - lens, lens)
        self.db.register("given_ids", pa.table({"word": word, "pos": pos, "tok": ids.flatten()}))
        out = [""] * len(ids)
        for i, text in self.db.execute(JOINED).fetchall():
            out[i] = text.translate(self.bytes).encode("latin-1").decode("utf-8", "replace")
        return out


_encoders: dict[str, Encoder] = {}
_decoders: dict[str, Decoder] = {}


def _encoder(name: str, make: Callable[[], dict]) -> Encoder:
    """One per worker process and vocabulary, kept from task to task."""
    if name not in _encoders:
        _encoders[name] = Encoder(make())
    return _encoders[name]


def encode(df: DataFrame, text: str, keep: list[str], tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k", count_only: bool = False) -> DataFrame:
    """The columns of `keep` and `ids`, the ids of `text` without special tokens, or `n_tokens`, their number. Strings
    that look like special tokens are ordinary text; null and empty texts have no ids; texts of any length are encoded
    whole; repeated rows give repeated rows.

    Narrow: each task encodes the rows it reads. The vocabulary (about a megabyte, fixed) is read once by the driver
    and sent along. Lengths of Arrow batches follow the session's settings.
    """
    path = f"{tokenizers.rstrip('/')}/{name}.json"
    sent = df.sparkSession.sparkContext.broadcast(vocabulary(path))
    chosen = df.select(*keep, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, lambda: sent.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                bounds, ids = enc.encode(part.column(part.num_columns - 1))
                last = pa.array(np.diff(bounds)) if count_only else pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], last], names=[*keep, "n_tokens" if count_only else "ids"])

    schema = df.select(*keep).schema.add("n_tokens", T.LongType()) if count_only else df.select(*keep).schema.add("ids", T.ArrayType(T.IntegerType()))
    return chosen.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str, keep: list[str], tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """The columns of `keep` and `decoded`, the text of the list `ids`; null and empty lists, and ids that aren't in the
    vocabulary, give nothing; bytes that are no UTF-8 give U+FFFD. Narrow, as `encode`."""
    path = f"{tokenizers.rstrip('/')}/{name}.json"
    sent = df.sparkSession.sparkContext.broadcast(pieces(path))
    schema = df.select(*keep).schema.add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _decoders:
            _decoders[path] = Decoder(sent.value, {c: b for b, c in alphabet().items()})
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(_decoders[path].decode(part.column(part.num_columns - 1)), pa.string())], names=[*keep, "decoded"])

    return df.select(*keep, F.col(ids).cast("array<int>").alias("__ids")).mapInArrow(run, schema)
