"""Text decoded with the wrong character encoding: which records hold it, and what it read before."""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Encodings that text may have been decoded with by mistake, and those it may have been written in.
SINGLE = ("latin-1", "cp1252", "cp1251", "cp1250", "koi8-r", "cp866", "cp437", "cp850", "mac_roman")
DOUBLE = ("gbk", "cp932", "euc_jp", "cp949", "big5")
#: Bigram counts are kept in 2^BITS hashed buckets, unigram counts per code point; so the model's size is fixed.
BITS, POINTS = 20, 0x110000
#: Weight of the unigrams in a bigram's probability, and of a code point that was never seen.
SMOOTH, UNSEEN = 2.0, 0.1
#: Log-likelihood that a reading must gain to be accepted. Of the clean lines held out in the tests none gains as much
#: by any chain, and nearly all lines garbled there do.
MARGIN = 5.0
#: Logarithm of a bigram's probability below which passages are looked for around it.
RARE = -8.5
#: From here on code points are East Asian, written without spaces.
EAST = 0x2E80
#: Rare pairs so many characters apart belong to one passage.
GAP = 3
#: Gain that a passage must make, over the margin of a line: lines have several passages, with several bounds each.
STRICTER = 2.0
#: Pieces, passages and lines whose readings are kept, as words, terms and whole lines come again, and the longest line kept.
REMEMBERED, LONGEST = 50_000, 1_000
#: Gains of lines are summed in single precision over pieces; a line isn't read out only if none comes so near to a gain.
#: Longer lines are always read out. So many records are judged together, and lines of so many characters scored at once.
SLACK, SUMMED = 0.01, 10_000
AT_ONCE, PORTION = 500, 500_000


def _table(codec: str) -> dict[int, str]:
    """The characters of bytes 128 to 255; bytes that a Windows code page leaves open stand for C1 controls."""
    out = {}
    for b in range(128, 256):
        try:
            out[b] = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            if codec.startswith("cp125"):
                out[b] = chr(b)
    return out


def _class(table: dict[int, str], lo: int, hi: int) -> str:
    return "[" + "".join(re.escape(table[b]) for b in range(lo, hi + 1) if b in table) + "]"


TABLES = {w: _table(w) for w in SINGLE}
#: The same as Python's charmap codec takes them, to encode and to decode.
DECODE = {w: "".join(map(chr, range(128))) + "".join(t.get(b, "\ufffe") for b in range(128, 256)) for w, t in TABLES.items()}
ENCODE = {w: codecs.charmap_build(t) for w, t in DECODE.items()}
#: Encodings in which byte 160 is a no-break space, which has often become a plain one: à, C3 A0, then ends in a space.
SPACED = ("latin-1", "cp1252", "cp1251", "cp1250")
#: What a multi-byte UTF-8 sequence looks like in each single-byte encoding.
UTF8_AS = {
    w: re.compile("|".join([*(_class(t, lo, hi) + f"{_class(t, 0x80, 0xBF)}{{{n}}}" for lo, hi, n in ((0xC2, 0xDF, 1), (0xE0, 0xEF, 2), (0xF0, 0xF4, 3))), *[t[0xC3] + " "] * (w in SPACED)]))
    for w, t in TABLES.items()
}
KNOWN = {c for t in TABLES.values() for c in t.values()}
#: The characters beyond ASCII of each single-byte encoding, those that begin a UTF-8 sequence there, and stretches of
#: text in three of them, whose bytes may be double-byte text next to intact characters.
CHARS = {w: frozenset(t.values()) for w, t in TABLES.items()}
LEADS = {w: frozenset(c for b, c in t.items() if 0xC2 <= b <= 0xF4) for w, t in TABLES.items()}
WITHIN = {w: re.compile("[\x00-\x7f" + "".join(re.escape(c) for c in TABLES[w].values()) + "]{2,}") for w in ("latin-1", "cp1252", "mac_roman")}


def _classes() -> np.ndarray:
    """Per code point of the basic plane, bits that `suspicious` combines: in which encodings it stands for a byte that
    continues a UTF-8 sequence (bits 0 to 5), or begins one of two (8 to 13) or three bytes (16 to 21) as Latin, Greek,
    Cyrillic, East Asian characters and punctuation have them; and scripts (24 to 29)."""
    k = np.zeros(0x10000, dtype=np.uint32)
    for i, w in enumerate(("latin-1", "cp1252", "cp1251", "cp437", "cp850", "mac_roman")):
        for b, c in TABLES[w].items():
            if b < 0xC0:
                k[ord(c)] |= 1 << i
            elif b in ((0xC2, 0xC3) if w == "mac_roman" else (0xC2, 0xC3, 0xCE, 0xCF, 0xD0, 0xD1)):
                k[ord(c)] |= 1 << (8 + i)
            elif b == 0xE2 or w != "mac_roman" and b in (*range(0xE3, 0xED), 0xEF):
                k[ord(c)] |= 1 << (16 + i)
    for bit, spans in ((24, "\x80\x9f��"), (25, "\xc0\xff"), (26, "аяёё"), (27, "АЯЁЁ"), (28, "ｦﾟ"), (29, "ЂЏђђѓџ")):
        for lo, hi in zip(spans[::2], spans[1::2]):
            k[ord(lo) : ord(hi) + 1] |= 1 << bit
    return k


CLASSES = _classes()


def suspicious(x: np.ndarray) -> np.ndarray:
    """Where in the code points x something begins that keeps a record from counting as clean: controls and lost
    characters, what a UTF-8 sequence would look like in a wrong encoding, and runs as of a wrong code page."""
    at = np.flatnonzero(x > 127)
    y = np.append(x, np.zeros(3, np.uint32))
    a, b, c, d = (CLASSES[np.minimum(y[at + i], 0xFFFF)] for i in range(4))
    script = (a & (b >> 1) & (1 << 26)) | (a & b & (1 << 29)) | (a & b & c & (1 << 28)) | (a & b & c & d & (1 << 25)) | (a & (1 << 24))
    return at[(script | ((a >> 8) & b & 63) | ((a >> 16) & b & c & 63)) != 0]


ENTITY = re.compile(r"&#(1[2-9]\d|2[0-4]\d|25[0-5]);")
HIGH = re.compile("[^\x00-\x7f]+")
HIGH_EAST = re.compile("[\u2e80-\uffff]")
#: Runs beyond ASCII with single ASCII characters between them. A double-byte encoding takes one ASCII character after a run
#: at most, so a reading of a line differs from it in its pieces, each with one character before and two after, each by itself.
PIECE = re.compile("[^\x00-\x7f]+(?:[\x00-\x7f]?[^\x00-\x7f]+)*")


def _utf8_classes() -> list[np.ndarray]:
    """Per code point of the basic plane, a bit for each of SINGLE where it stands for a byte that begins a UTF-8 sequence of
    two, three and four, that continues one, and, as C3 of SPACED, may come before a plain space."""
    out = [np.zeros(0x10000, np.uint16) for _ in range(5)]
    for i, w in enumerate(SINGLE):
        for k, lo, hi in ((0, 0xC2, 0xDF), (1, 0xE0, 0xEF), (2, 0xF0, 0xF4), (3, 0x80, 0xBF), *[(4, 0xC3, 0xC3)] * (w in SPACED)):
            out[k][[ord(TABLES[w][b]) for b in range(lo, hi + 1) if b in TABLES[w]]] |= 1 << i
    return out


UTF8_CLASSES = _utf8_classes()


def _utf8_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """At the places `at` of the code points x a bit for each of SINGLE whose UTF8_AS matches there."""
    two, three, four, on, spaced = UTF8_CLASSES
    y = np.minimum(np.append(x, np.zeros(3, np.uint32)), 0xFFFF)
    a, b, c, d = (y[at + i] for i in range(4))
    return (on[b] & (two[a] | on[c] & (three[a] | four[a] & on[d]))) | np.where(b == 32, spaced[a], 0)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _hashed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS)


def _buckets(x: np.ndarray) -> np.ndarray:
    return _hashed(x[:-1], x[1:])


@dataclass
class Model:
    """Counts of character pairs (hashed) and of characters in clean records; `pieces`, `said`, `known` and `lines` hold gains and
    readings of pieces, lines and passages that came up before, REMEMBERED at most."""

    pairs: np.ndarray
    chars: np.ndarray
    known: dict[str, tuple] = field(default_factory=dict)
    lines: dict[tuple[str, frozenset[str] | None], tuple] = field(default_factory=dict)
    pieces: dict[tuple[str, bool], int] = field(default_factory=dict)
    said: dict[str, tuple[frozenset[str], bool, np.ndarray | None]] = field(default_factory=dict)
    held: int = 0  # characters of what is said

    def __post_init__(self) -> None:
        self.total = float(self.chars.sum())
        self.base = ((self.chars + UNSEEN) / (self.total + UNSEEN * 50_000)).astype(np.float32)
        self.gains, self.likelier, self.rare = np.zeros((1024, COLUMNS), np.float32), np.zeros(1024, bool), np.zeros(1024, bool)
        self.bytes: list[np.ndarray] = []

    def byte_steps(self) -> list[np.ndarray]:
        """For each of SINGLE the steps from each byte to each other, first times 256 plus second; none for open bytes."""
        for codec in SINGLE if not self.bytes else ():
            x = _points(DECODE[codec])
            t = self._logs(np.repeat(x, 256), np.tile(x, 256)).reshape(256, 256)
            t[x == 0xFFFE] = t[:, x == 0xFFFE] = -np.inf
            self.bytes.append(t.ravel())
        return self.bytes

    def steps(self, x: np.ndarray) -> np.ndarray:
        """Logarithms of the smoothed probabilities of each code point of x after the one before it. A pair is no more
        frequent than its characters are, whatever else falls into its bucket."""
        return self._logs(x[:-1], x[1:])

    def steps_at(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The same for the steps from the places `at` on only."""
        return self._logs(x[at], x[at + 1])

    def _logs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = self.chars[a]
        return np.log((np.minimum(np.minimum(self.pairs[_hashed(a, b)], n), self.chars[b]) + SMOOTH * self.base[b]) / (n + SMOOTH))

    def scores(self, lines: list[str]) -> np.ndarray:
        """The log-likelihood of each line."""
        x = _points("\n" + "\n".join(lines) + "\n")
        ends = np.cumsum([len(s) + 1 for s in lines])
        up = np.append(0.0, np.cumsum(self.steps(x), dtype=np.float64))
        return np.diff(up[np.append(0, ends)])


def count(texts: list[str | None], pairs: np.ndarray, chars: np.ndarray) -> None:
    """Adds the counts of the clean ones of `texts`."""
    held, n = [], 0
    for i, t in enumerate([*texts, None]):
        if t and "&#" not in t:
            held.append(t)
            n += len(t)
        if held and (n > 1_000_000 or i == len(texts)):
            x = _points("\n" + "\n".join(held) + "\n")
            ends = np.cumsum([len(t) + 1 for t in held])
            bad = np.unique(np.searchsorted(ends, suspicious(x), side="left"))
            if len(bad):
                x = _points("\n" + "\n".join(t for j, t in enumerate(held) if j not in set(bad.tolist())) + "\n")
            pairs += np.bincount(_buckets(x), minlength=1 << BITS)
            chars += np.bincount(x, minlength=POINTS)
            held, n = [], 0


def clean(text: str) -> bool:
    """Whether `count` takes `text`."""
    return "&#" not in text and (text.isascii() or not len(suspicious(_points(text))))


def cleans(texts: list[str]) -> list[bool]:
    """`clean` for each of the texts, about a million characters at once."""
    out: list[bool] = []
    ends = np.cumsum([len(t) for t in texts])
    for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends // 1_000_000)) + 1):
        some = [texts[i] for i in part]
        at = suspicious(_points("\n" + "\n".join(some) + "\n"))
        bad = set(np.searchsorted(np.cumsum([len(t) + 1 for t in some]), at, side="left").tolist())
        out += [i not in bad and "&#" not in t for i, t in enumerate(some)]
    return out


def train(df: DataFrame, text: str, first: Model | None = None) -> Model:
    """The model of all clean records of `df`; with a `first` model, those that hold a case by it don't count either. Each task counts what it reads and sends one row per bucket and code
    point that occurs; these are summed, and what the driver gets is bounded by the number of buckets and of code
    points, about two million, whatever the input's size. Null texts don't count; with no clean record all is unseen."""
    every = Model(*_counts(df, text))
    return every if first is None else without(every, suspects(df, text, [], first), "text")


def without(model: Model, suspected: DataFrame, text: str) -> Model:
    """`model` less what the clean ones among the cases of `suspected` have added to it."""
    pairs, chars = _counts(suspected.where("affected"), text)
    return Model(np.maximum(model.pairs - pairs, 0), np.maximum(model.chars - chars, 0))


def _counts(df: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, chars = np.zeros(1 << BITS, np.int64), np.zeros(POINTS, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                count(batch.column(0).slice(i, 1000).to_pylist(), pairs, chars)
        for kind, counts in ((0, pairs), (1, chars)):
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["kind", "at", "n"])

    rows = df.select(text).mapInArrow(run, "kind int, at int, n long").groupBy("kind", "at").agg(F.sum("n").alias("n")).toArrow()
    kind, at, n = (rows.column(c).to_numpy() for c in ("kind", "at", "n"))
    out = np.zeros(1 << BITS, np.float32), np.zeros(POINTS, np.float32)
    for k in (0, 1):
        out[k][at[kind == k]] = n[kind == k]
    return out


def _encode(line: str, codec: str) -> bytes | None:
    """The bytes of `line`, lost characters as 255 in double-byte encodings; none if it holds others that it lacks."""
    try:
        if codec in ENCODE:
            return codecs.charmap_encode(line, "strict", ENCODE[codec])[0]
        if "�" in line:
            return line.replace("�", "\x7f").encode(codec).replace(b"\x7f", b"\xff")
        return line.encode(codec)
    except UnicodeEncodeError:
        return None


def _decode(raw: bytes, codec: str) -> str | None:
    try:
        return codecs.charmap_decode(raw, "strict", DECODE[codec])[0] if codec in DECODE else raw.decode(codec)
    except UnicodeDecodeError:
        return None


def _utf8_in(text: str, wrong: str, chars: set[str], model: Model) -> str:
    def right(m: re.Match) -> str:
        got = _decode((_encode(m.group(), wrong) or b"\xff").replace(b" ", b"\xa0"), "utf-8")
        return got if got and (got in KNOWN or model.chars[ord(got[0])]) else m.group()

    return text if chars.isdisjoint(LEADS[wrong]) else UTF8_AS[wrong].sub(right, text)


def readings(line: str, model: Model, only: frozenset[str] | None = None) -> dict[str, str]:
    """Every other reading of `line` and the chain that gives it, 'wrong>right', or those of the chains `only`."""
    runs = [(m.start(), m.end(), m.group()) for m in HIGH.finditer(line)]
    high = set().union(*(r[2] for r in runs))
    out: dict[str, str] = {}

    def rights(wrong: str, among: tuple[str, ...]) -> list[str]:
        return [r for r in among if r != wrong and (only is None or f"{wrong}>{r}" in only)]

    def offer(text: str | None, chain: str) -> None:
        if text and text != line and "\x00" not in text:
            out.setdefault(text, chain)

    def spliced(parts: list[tuple[int, int, str]]) -> str:
        at, held = 0, []
        for a, b, t in parts:
            held += [line[at:a], t]
            at = b
        return "".join([*held, line[at:]])

    seen: set[bytes] = set()
    for wrong in SINGLE:
        if only is None or f"{wrong}>utf-8" in only or f"{wrong}>utf-8 twice" in only:
            once = _utf8_in(line, wrong, high, model)
            if once != line:
                offer(once, f"{wrong}>utf-8")
                offer(_utf8_in(once, wrong, set(once), model), f"{wrong}>utf-8 twice")
        doubles, singles = rights(wrong, DOUBLE), rights(wrong, SINGLE)
        if not doubles and not singles:
            continue
        raw = _encode(line, wrong) if high <= CHARS[wrong] else None
        if raw is not None:
            if raw in seen:  # the same bytes, and so the same readings, as by an encoding before
                continue
            seen.add(raw)
            for right in (*doubles, *singles):
                offer(_decode(raw, right), f"{wrong}>{right}")
        elif wrong in WITHIN and not high.isdisjoint(CHARS[wrong]):
            within = [(m.start(), m.end(), _encode(m.group(), wrong)) for m in WITHIN[wrong].finditer(line) if not m.group().isascii()]
            for right in doubles if within else ():
                offer(spliced([(a, b, (raw and _decode(raw, right)) or line[a:b]) for a, b, raw in within]), f"{wrong}>{right}")
    east = HIGH_EAST.search(line) is not None
    for wrong in DOUBLE if east else ():
        utf8, doubles = rights(wrong, ("utf-8",)), rights(wrong, DOUBLE)
        if not utf8 and not doubles:
            continue
        raw = _encode(line, wrong)
        if raw is not None:
            if utf8:
                offer(raw.decode("utf-8", "replace"), f"{wrong}>utf-8")
            for right in doubles:
                offer(_decode(raw, right), f"{wrong}>{right}")
        elif utf8:
            raws = [_encode(t, wrong) for _, _, t in runs]
            if any(raws):
                offer(spliced([(a, b, raw.decode("utf-8", "replace") if raw else t) for (a, b, t), raw in zip(runs, raws)]), f"{wrong}>utf-8")
    if only is None and ENTITY.search(line):
        plain = ENTITY.sub(lambda m: chr(int(m.group(1))), line)
        for wrong in ("latin-1", "cp1252"):
            fixed = _utf8_in(plain, wrong, set(plain), model)
            if fixed != plain:
                offer(fixed, f"entities>{wrong}>utf-8")
    return out


#: Columns of the gains of a piece: wrong and right single-byte, wrong single-byte and right double-byte, UTF-8 once and twice,
#: stretches next to characters that the wrong encoding lacks, wrong double-byte and UTF-8, wrong and right double-byte.
N, D = len(SINGLE), len(DOUBLE)
TO_DOUBLE, TO_UTF8, TWICE, PARTS, EAST_UTF8, EAST_DOUBLE, COLUMNS = np.cumsum([N * N, N * D, N, N, len(WITHIN) * D, D, D * D]).tolist()
CHAIN = [f"{w}>{r}" for ws, rs in ((SINGLE, SINGLE), (SINGLE, DOUBLE), (SINGLE, ["utf-8"]), (SINGLE, ["utf-8 twice"]), (WITHIN, DOUBLE), (DOUBLE, ["utf-8"]), (DOUBLE, DOUBLE)) for w in ws for r in rs]




def _fits() -> np.ndarray:
    """Per code point of the basic plane a bit for each of SINGLE and DOUBLE that has it."""
    k = np.zeros(0x10000, np.uint16)
    k[:128] = (1 << N + D) - 1
    for i, w in enumerate(SINGLE):
        k[[ord(c) for c in TABLES[w].values()]] |= 1 << i
    every = "".join(map(chr, [*range(128, 0xD800), *range(0xE000, 0xFFFF)]))
    for i, w in enumerate(DOUBLE, N):
        k[_points(every)] |= (_points(every.encode(w, "replace").decode(w)) != ord("?")).astype(np.uint16) << i
    return k


FITS = _fits()
#: The bits of WITHIN.
STRETCHES = np.uint16(sum(1 << SINGLE.index(w) for w in WITHIN))


def _begins(codec: str) -> np.ndarray:
    """For each byte and the next, first times 256 plus second, whether text in a double-byte encoding may begin with them."""
    pairs = b"".join(bytes([a, b if b != 10 else 13, 10]) for a in range(128, 256) for b in range(256))  # no character ends in either
    out = np.array([True] * 128 * 256 + [t[0] != "\ufffd" for t in pairs.decode(codec, "replace").split("\n")[:-1]])
    if codec == "euc_jp":  # has characters of three bytes
        out[0x8F * 256 : 0x90 * 256] = True
    return out


#: Of a run of bytes beyond ASCII the first begins a character, as those before it are no part of one that goes on in it.
BEGINS = {w: _begins(w) for w in DOUBLE}


def _sums(x: np.ndarray, model: Model) -> np.ndarray:
    """The log-likelihood of each line of code points that begin and end with a line break."""
    return np.add.reduceat(model.steps(x).astype(np.float64), np.flatnonzero(x[:-1] == 10))


def _learn(keys: list[tuple[str, bool]], model: Model) -> None:
    """Adds the gains of pieces, all at once, and whether they have rare pairs, to what the model remembers. A key is a piece
    and whether its line has East Asian characters."""
    start, texts, east = len(model.pieces), [k for k, _ in keys], np.array([e for _, e in keys])
    model.pieces.update((k, start + i) for i, k in enumerate(keys))
    while len(model.rare) < len(model.pieces):
        model.gains, model.likelier, model.rare = (np.concatenate([a, np.zeros_like(a)]) for a in (model.gains, model.likelier, model.rare))
    gains = np.zeros((COLUMNS, len(keys)), np.float32).T  # filled by column
    x = _points("\n" + "\n".join(texts) + "\n")
    breaks = np.flatnonzero(x == 10)
    own = _sums(x, model)
    model.rare[start : len(model.pieces)] = np.logical_or.reduceat(_rare_at(x, model), breaks[:-1])
    bits = FITS[np.minimum(x, 0xFFFF)]
    fits = np.bitwise_and.reduceat(bits, breaks[:-1])
    high = np.flatnonzero(x > 127)
    utf8 = np.zeros(len(x), np.uint16)
    utf8[high] = _utf8_at(x, high)
    utf8 = np.bitwise_or.reduceat(utf8, breaks[:-1])  # in which of SINGLE a UTF-8 sequence may be read
    within = np.bitwise_or.reduceat(np.where(x > 127, bits, 0), breaks[:-1]) & ~fits & STRETCHES  # which has some characters only
    # a lost character, of which the key has none and clean records neither, has at most this probability
    lost = float(np.log(model.base[0xFFFD])) if not model.chars[0xFFFD] else 0.0

    def read(rows: np.ndarray, raw: bytes, right: str, column: int) -> None:
        """Gains of the rows by the reading of raw, their bytes; strict, but in UTF-8, where a bound does if half is lost."""
        text = codecs.charmap_decode(raw, "replace", DECODE[right])[0] if right in DECODE else raw.decode(right, "replace")
        y = _points("\n" + text + "\n")
        at = np.flatnonzero(y == 10)
        gone = np.add.reduceat((y == 0xFFFD).astype(np.int32), at[:-1])
        bad = gone > (np.diff(at) // 3 if right == "utf-8" else 0)
        gains[rows[bad], column] = (lost * gone - own[rows])[bad] if right == "utf-8" else -np.inf
        if bad.any():
            y = y[np.append(True, np.repeat(~bad, np.diff(at)))]
        rows = rows[~bad]
        if len(rows):
            g = _sums(y, model) - own[rows]
            gains[rows, column] = np.where(np.abs(g) < 1e-7, 0, g)

    for i, wrong in enumerate((*SINGLE, *DOUBLE)):
        can = (fits >> i & 1).astype(bool) & (east if i >= N else True)
        if i < N:
            gains[~can, i * N : i * N + N] = gains[~can, TO_DOUBLE + i * D : TO_DOUBLE + i * D + D] = -np.inf
        else:
            gains[~can, EAST_DOUBLE + (i - N) * D : EAST_DOUBLE + (i - N) * D + D] = -np.inf
        rows = np.flatnonzero(can)
        if not len(rows):
            continue
        raw = _encode("\n".join([texts[k] for k in rows]), wrong)
        b = np.frombuffer(b"\n" + raw + b"\n", np.uint8).astype(np.int32)
        steps, at, raws = b[:-1] * 256 + b[1:], np.flatnonzero(b == 10), raw.split(b"\n")
        if i < N:
            for j, table in enumerate(model.byte_steps()):
                if j != i:
                    g = np.add.reduceat(table[steps].astype(np.float64), at[:-1]) - own[rows]
                    gains[rows, i * N + j] = np.where(np.abs(g) < 1e-7, 0, g)
        else:
            read(rows, raw, "utf-8", EAST_UTF8 + i - N)
        first = np.flatnonzero((b[1:] > 127) & (b[:-1] < 128)) + 1
        of, first = np.searchsorted(at, first) - 1, steps[first]
        for j, right in enumerate(DOUBLE):
            if j != i - N:
                column = TO_DOUBLE + i * D + j if i < N else EAST_DOUBLE + (i - N) * D + j
                can = np.ones(len(rows), bool)
                can[of[~BEGINS[right][first]]] = False
                gains[rows[~can], column] = -np.inf
                if can.any():
                    read(rows[can], b"\n".join([raws[k] for k in np.flatnonzero(can).tolist()]), right, column)
    held: dict[bytes, list[tuple[int, str]]] = {}
    other = [(k, column, text) for k in np.flatnonzero(utf8 | within).tolist() for column, text in _loose(texts[k], int(utf8[k]), int(within[k]), held, model)]
    mixed = {k: runs for k in np.flatnonzero(east & (fits >> N != (1 << D) - 1)).tolist() if len(runs := HIGH.findall(texts[k])) > 1}
    every = list(dict.fromkeys(r for runs in mixed.values() for r in runs))
    z = _points("\n".join([*every, ""]))
    bits = np.bitwise_and.reduceat(FITS[np.minimum(z, 0xFFFF)], np.append(0, np.flatnonzero(z == 10)[:-1] + 1)).tolist() if every else []
    for i, wrong in enumerate(DOUBLE):
        fit = [r for r, b in zip(every, bits) if b >> N + i & 1]
        fixed = dict(zip(fit, "\n".join(fit).encode(wrong).decode("utf-8", "replace").split("\n")))
        for k, runs in mixed.items():
            if not fits[k] >> N + i & 1 and not fixed.keys().isdisjoint(runs):
                text = HIGH.sub(lambda m: fixed.get(m.group(), m.group()), texts[k])
                if (gone := text.count("�")) > len(text) // 3:
                    gains[k, EAST_UTF8 + i] = lost * gone - own[k]
                else:
                    other.append((k, EAST_UTF8 + i, text))
    if other:
        k, column, read_out = zip(*other)
        g = model.scores(read_out) - own[list(k)]
        several = (np.array(column) >= PARTS) & (np.array(column) < EAST_UTF8)
        np.add.at(gains, (list(k), list(column)), np.where(several, np.maximum(g, 0), g))
    for i, wrong in enumerate(WITHIN):  # pieces that fit are one stretch
        w = SINGLE.index(wrong)
        can = (fits >> w & 1).astype(bool)
        gains[can, PARTS + i * D : PARTS + i * D + D] = np.maximum(gains[can, TO_DOUBLE + w * D : TO_DOUBLE + w * D + D], 0)
    model.gains[start : len(model.pieces)] = gains
    model.likelier[start : len(model.pieces)] = (gains > 0).any(axis=1)


def _loose(key: str, utf8: int, within: int, held: dict[bytes, list[tuple[int, str]]], model: Model) -> Iterator[tuple[int, str]]:
    """Column and text of the readings of a piece by chains that leave what they can't read, for the encodings of the bits
    `utf8` and `within`. In PARTS a column may have several texts, one for each stretch; which of them a line takes is left open.
    `held` keeps the double-byte readings of stretches, which come again."""
    high = set(key) if utf8 else NONE
    for i, wrong in enumerate(SINGLE):
        if utf8 >> i & 1:
            once = _utf8_in(key, wrong, high, model)
            if once != key:
                yield TO_UTF8 + i, once
                yield TWICE + i, _utf8_in(once, wrong, set(once), model)
    for i, wrong in enumerate(WITHIN):
        if within >> SINGLE.index(wrong) & 1:
            for m in WITHIN[wrong].finditer(key):
                raw = None if m.group().isascii() else _encode(m.group(), wrong)
                if raw and raw not in held:
                    held[raw] = [(j, text) for j, right in enumerate(DOUBLE) if (text := _decode(raw, right))]
                for j, text in held[raw] if raw else ():
                    if text != m.group():
                        yield PARTS + i * D + j, key[: m.start()] + text + key[m.end() :]


NONE: frozenset[str] = frozenset()
#: What is said of most lines.
NOTHING = (NONE, False, None)


def scan(lines: list[str], model: Model) -> None:
    """Finds out for each of the lines which chains may read it likeliest, if any reads it likelier at all, whether it
    has rare pairs in passages that may gain, and if so where. Gains are sums over pieces, exact but for PARTS and much lost text, where they are bounds; so
    `best_reading` finds the same among these chains as among all. Of lines that are very long, or hold entities or lost
    characters, nothing is said; they are read out by all chains."""
    if len(model.said) >= REMEMBERED or model.held > 20 * PORTION:
        model.said.clear()
        model.held = 0
    fresh = [line for line in dict.fromkeys(lines) if not line.isascii() and line not in model.said and len(line) <= SUMMED and "�" not in line and "&#" not in line]
    ends = np.cumsum([len(line) for line in fresh])
    if fresh:
        model.held += int(ends[-1])
        for part in np.split(np.arange(len(fresh)), np.flatnonzero(np.diff(ends // PORTION)) + 1):
            _scan(fresh[part[0] : part[-1] + 1], model)


def _scan(lines: list[str], model: Model) -> None:
    if len(model.pieces) >= REMEMBERED:
        model.pieces.clear()
    text = "\n".join(["", *lines, ""])
    x = _points(text)
    high, breaks = np.flatnonzero(x > 127), np.flatnonzero(x == 10)
    of, gaps = np.searchsorted(breaks, high) - 1, np.diff(high)
    starts = np.flatnonzero(np.append(True, (gaps > 2) | (np.diff(of) > 0)))  # of the pieces that PIECE finds
    stops, by = high[np.append(starts[1:], len(high)) - 1], of[starts]
    east, cuts = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
    east[of[(x[high] >= EAST) & (x[high] <= 0xFFFF)]] = True
    cuts[of[1:][(gaps == 2) & (x[high[1:] - 1] == 32)]] = True  # the bounds of words, which are those of passages but for East Asian text, cut a piece
    spans = zip(np.maximum(high[starts] - 1, breaks[by] + 1).tolist(), np.minimum(stops + 3, breaks[by + 1]).tolist(), east[by].tolist())
    keys = [(text[a:b], e) for a, b, e in spans]
    if fresh := list(dict.fromkeys(k for k in keys if k not in model.pieces)):
        _learn(fresh, model)
    rows = np.fromiter(map(model.pieces.__getitem__, keys), np.int64, len(keys))
    starts = np.flatnonzero(np.append(True, np.diff(by) > 0))
    some = np.logical_or.reduceat(model.likelier[rows], starts)  # elsewhere no piece gains, so nor does the line, nor a passage that cuts no piece
    rare = np.logical_or.reduceat(model.rare[rows], starts) & (some | east | cuts)
    said: list[tuple] = [NOTHING] * len(lines)
    if rare.any():
        at = np.zeros(len(x), bool)
        at[high[rare[of]]] = True
        at = np.flatnonzero(at[:-1] | at[1:])
        at = at[model.steps_at(x, at) < RARE]
        by = np.searchsorted(breaks, at, side="right") - 1
        for i, k in zip(np.flatnonzero(rare).tolist(), np.split(at - breaks[by], np.searchsorted(by, np.flatnonzero(rare)[1:]))):
            said[i] = NONE, True, k
    if some.any():
        sizes = np.diff(np.append(starts, len(rows)))
        rows, sizes = rows[np.repeat(some, sizes)], sizes[some]
        sums = np.add.reduceat(model.gains[rows], np.append(0, np.cumsum(sizes)[:-1]), axis=0)
        sums[sums == 0] = -np.inf
        sure = np.maximum(sums[:, :PARTS].max(axis=1), sums[:, EAST_DOUBLE:].max(axis=1))
        best = sums > np.maximum(sure, 0)[:, None] - SLACK
        some = np.flatnonzero(some)
        for i in np.flatnonzero(best.any(axis=1)).tolist():
            k = int(some[i])
            said[k] = frozenset(CHAIN[j] for j in np.flatnonzero(best[i]).tolist()), *said[k][1:]
    model.said.update(zip(lines, said))


def best_reading(line: str, model: Model, only: frozenset[str] | None = None) -> tuple[str, str, float]:
    """(text, chain, gain) of the likeliest other reading, by one of the chains `only` if given; a gain of 0 if there is none better."""
    if (line, only) in model.lines:
        return model.lines[line, only]
    best, other = (line, "", 0.0), readings(line, model, only)
    if other:
        scores = model.scores([line, *other])
        k = int(scores[1:].argmax())
        text, chain = list(other.items())[k]
        gain = float(scores[k + 1] - scores[0])
        if gain > 0:
            best = text, chain, gain
    if len(model.lines) >= REMEMBERED:
        model.lines.clear()
    if len(line) <= LONGEST:
        model.lines[line, only] = best
    return best


def passages(line: str, model: Model) -> list[tuple[int, int]]:
    """Bounds of parts of `line` that may be garbled by themselves: whole words around rare pairs, single and in runs with
    ASCII between them; of East Asian text the characters from the first rare pair to the last, give or take one."""
    at = model.said[line][2] if line in model.said else None
    if at is None:
        at = np.flatnonzero(_rare_steps("\n" + line + "\n", model)[0])
    out: dict[tuple[int, int], None] = {}
    runs: list[list[int]] = []
    words: list[tuple[int, int]] = []
    for k in at.tolist():
        if (k < len(line) and ord(line[k]) >= EAST) or (k and ord(line[k - 1]) >= EAST):
            if runs and k - runs[-1][1] <= GAP:
                runs[-1][1] = k
            else:
                runs.append([k, k])
        else:
            a = max(k - 1, 0) if k and not line[k - 1].isspace() else k
            a, b = line.rfind(" ", 0, a + 1) + 1, line.find(" ", k)
            b = len(line) if b < 0 else b
            if a < b and (not words or words[-1][1] < b):
                words.append((a, b))
    for lo, hi in runs:
        out |= dict.fromkeys((a, b) for a in (lo, lo - 1) for b in (hi, hi + 1) if 0 <= a < b <= len(line))
    start = 0
    for i, (a, b) in enumerate(words):
        out[a, b] = None
        if i + 1 == len(words) or not line[b : words[i + 1][0]].isascii():
            out[words[start][0], b] = None
            start = i + 1
    whole = (0, len(line))
    return [p for p in out if p != whole and not line[p[0] : p[1]].isascii()]


def _best_within(before: str, text: str, after: str, model: Model) -> tuple[str, str, float]:
    """(text, chain, gain) of the likeliest reading of a passage between two characters; a gain of 0 where there is none,
    or it has lost characters or more than a third of the rare pairs."""
    key = before + text + after
    if key in model.known:
        return model.known[key]
    best, other = (text, "", 0.0), readings(text, model)
    if other:
        scores = model.scores([key, *(before + t + after for t in other)])
        k = int(scores[1:].argmax())
        fixed, chain = list(other.items())[k]
        gain = float(scores[k + 1] - scores[0])
        if gain > 0 and "�" not in fixed and 3 * _rare(before + fixed + after, model) <= _rare(key, model):
            best = fixed, chain, gain
    if len(model.known) >= REMEMBERED:
        model.known.clear()
    model.known[key] = best
    return best


def _rare_steps(text: str, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Where text goes on with a rare pair beyond ASCII, and its code points."""
    x = _points(text)
    return _rare_at(x, model), x


def _rare_at(x: np.ndarray, model: Model) -> np.ndarray:
    high = x > 127
    at = np.flatnonzero(high[1:] | high[:-1])
    rare = np.zeros(len(x) - 1, dtype=bool)
    rare[at] = model.steps_at(x, at) < RARE
    return rare


def _rare(text: str, model: Model) -> int:
    return int(_rare_steps(text, model)[0].sum())


def likelier_passages(line: str, model: Model) -> list[tuple[int, int, str, str, float]]:
    """(from, to, text, chain, gain) of passages that gain at all. Of the rare pairs that a passage holds, its reading may
    keep a third."""
    found, east = [], HIGH_EAST.search(line) is not None
    spans = [(a, b, model.pieces.get((line[a - 1 if a else 0 : b + 2], east))) for a, b in map(re.Match.span, PIECE.finditer(line))]
    spans = [(a, b, row is None or bool(model.likelier[row])) for a, b, row in spans]
    for a, b in passages(line, model):
        if "&#" not in line and not any(x < b and a < y and (likelier or x < a or b < y) for x, y, likelier in spans):
            continue  # whole pieces, none of which gains
        before, after = line[a - 1] if a else "\n", line[b] if b < len(line) else "\n"
        text, chain, gain = _best_within(before, line[a:b], after, model)
        if gain > 0:
            found.append((a, b, text, chain, gain))
    return found


def best_passages(line: str, model: Model, least: float) -> list[tuple[int, int, str, str, float]]:
    """Those of them that gain more than `least` and don't overlap, the likeliest first."""
    return _apart(likelier_passages(line, model), least)


def _apart(found: list[tuple[int, int, str, str, float]], least: float) -> list[tuple[int, int, str, str, float]]:
    kept: list[tuple[int, int, str, str, float]] = []
    for f in sorted((f for f in found if f[4] > least), key=lambda f: (-f[4], f[0], f[1])):
        if all(f[1] <= g[0] or g[1] <= f[0] for g in kept):
            kept.append(f)
    return kept


@dataclass
class Repair:
    text: str
    gain: float
    chains: list[str]
    lost: bool
    close: bool = False

    @property
    def affected(self) -> bool:
        return bool(self.chains) or self.lost


def repair(text: str, model: Model, margin: float = MARGIN, every: bool = False) -> Repair:
    """`text` with each line read by its likeliest chain, if that gains more than `margin` over the line as it is; a chain
    that gains more than twice the margin in several lines of the text together is accepted in each of them. Where passages
    of a line, each by a chain of its own, gain clearly more than the whole line does, they are read instead, unless the
    whole line's reading has no rare pair left. All lines with anything beyond ASCII are scored by all chains, and chains
    are undone one after another as long as one is accepted, which ends, as the line gains each time. `lost`: characters
    are left that no chain brings back; `close`: some line or passage has a likelier reading, accepted or not. With `every`
    lines are read out whole by all chains, not only by those that the sums over their pieces leave; slower, and the same."""
    return _repaired([text], model, margin, every)[0]


def _repaired(texts: list[str], model: Model, margin: float, every: bool, brief: bool = False) -> list[Repair]:
    """`repair` of each of the texts; what a round reads is scanned for all of them together. With `brief` only `affected` is
    as there: it is true as soon as one chain is accepted, whatever is undone besides."""
    done: list[Repair] = [None] * len(texts)
    open_ = {i: _rounds(t, model, margin, every, brief) for i, t in enumerate(texts)}
    while open_:
        lines: list[str] = []
        for i, rounds in [*open_.items()]:
            try:
                lines += next(rounds)
            except StopIteration as end:
                done[i] = end.value
                del open_[i]
        if not every:
            scan(lines, model)
    return done


def _rounds(text: str, model: Model, margin: float, every: bool, brief: bool) -> Generator[list[str], None, Repair]:
    """Says before each round of undoing which lines it reads."""
    lost = "�" in text
    if brief and lost or text.isascii() and "&#" not in text:
        return Repair(text, 0.0, [], lost)
    lines = text.split("\n")
    at = {i for i, s in enumerate(lines) if not s.isascii() or "&#" in s}
    gain, chains, close = 0.0, [], False
    while at:
        yield [lines[i] for i in at]
        said = {} if every else {i: s for i in at if (s := model.said.get(lines[i]))}
        likely, rare = ([i for i in sorted(at) if i not in said or said[i][k]] for k in (0, 1)) if any(said.get(i) is not NOTHING for i in at) else ([], [])
        found = {}
        for i in likely:
            found[i] = f = best_reading(lines[i], model, said[i][0] if i in said else None)
            if brief and f[2] > margin:
                return Repair(text, f[2], [f[1]], lost)
        support: dict[str, list[float]] = {}
        for _, chain, g in found.values():
            if g > margin / 2:
                support.setdefault(chain, []).append(g)
        good = {i: (f[0], [f[1]], f[2]) for i, f in found.items() if f[2] > margin or (f[2] > margin / 2 and len(support[f[1]]) > 1 and sum(support[f[1]]) > 2 * margin)}
        close |= any(f[2] > 0 for f in found.values())
        if brief and good:
            return Repair(text, sum(g[2] for g in good.values()), [c for g in good.values() for c in g[1]], lost)
        for i in rare:
            if i in good and not _rare("\n" + good[i][0] + "\n", model):
                continue
            likelier = likelier_passages(lines[i], model)
            close |= bool(likelier)
            parts = _apart(likelier, margin * STRICTER)
            g = sum(p[4] for p in parts)
            if brief and parts:
                return Repair(text, g, [p[3] for p in parts], lost)
            if parts and (i not in good or g > good[i][2] + margin * STRICTER):
                fixed = lines[i]
                for a, b, t, _, _ in sorted(parts, reverse=True):
                    fixed = fixed[:a] + t + fixed[b:]
                good[i] = fixed, [p[3] for p in parts], g
        for i, (fixed, by, g) in sorted(good.items()):
            lines[i], gain = fixed, gain + g
            chains += by
        at = set(good)
    fixed = "\n".join(lines)
    return Repair(fixed, gain, list(dict.fromkeys(chains)), lost or "�" in fixed, close)


def suspects(df: DataFrame, text: str, keep: list[str], model: Model, margin: float = MARGIN, every: bool = False) -> DataFrame:
    """The columns of `keep`, text, and affected (always true), of each record that is a case by `model`, of those that have
    a part in it; the others aren't judged. Narrow."""

    def judge(texts: list[str], m: Model) -> list[Repair]:
        fit = cleans(texts)
        judged = iter(_repaired([t for t, f in zip(texts, fit) if f], m, margin, every, brief=True))
        return [next(judged) if f else Repair(t, 0.0, [], False) for t, f in zip(texts, fit)]

    return _judged(df, text, keep, model, judge, lambda r: r.affected, [("text", T.StringType(), pa.string(), lambda t, r: t), ("affected", T.BooleanType(), pa.bool_(), lambda t, r: r.affected)])


def cases(df: DataFrame, text: str, keep: list[str], model: Model, margin: float = MARGIN, every: bool = False) -> DataFrame:
    """The columns of `keep` of each record that `find` gives a row for. Narrow."""
    return _judged(df, text, keep, model, lambda texts, m: _repaired(texts, m, margin, every, brief=True), lambda r: r.affected, [])


def find(df: DataFrame, text: str, keep: list[str], model: Model, margin: float = MARGIN, every: bool = False) -> DataFrame:
    """The columns of `keep`, restored (the text with what could be restored), chains, gain and lost of each record
    whose text holds a passage decoded wrongly; others give no row. Null and empty texts are no cases; texts of any
    length are read whole; repeated rows are judged alike. Narrow: the model, of fixed size, is sent to the tasks. `every`
    reads out all lines, as in `repair`."""
    said = [("restored", T.StringType(), pa.string(), lambda t, r: r.text), ("chains", T.ArrayType(T.StringType()), pa.list_(pa.string()), lambda t, r: r.chains), ("gain", T.DoubleType(), pa.float64(), lambda t, r: r.gain), ("lost", T.BooleanType(), pa.bool_(), lambda t, r: r.lost)]
    return _judged(df, text, keep, model, lambda texts, m: _repaired(texts, m, margin, every), lambda r: r.affected, said)


def _judged(df: DataFrame, text: str, keep: list[str], model: Model, judge: Callable[[list[str], Model], list[Repair]], chosen: Callable[[Repair], bool], said: list[tuple]) -> DataFrame:
    """`keep` and what is `said` (name, type, Arrow type, function of text and repair) of the records whose repair is `chosen`."""
    sent = df.sparkSession.sparkContext.broadcast((model.pairs, model.chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for batch in batches:
            done = []
            for k in range(0, batch.num_rows, AT_ONCE):
                texts = [(i, t) for i, t in enumerate(batch.column(batch.num_columns - 1).slice(k, AT_ONCE).to_pylist(), k) if t]
                done += [(i, t, r) for (i, t), r in zip(texts, judge([t for _, t in texts], m)) if chosen(r)]
            rows = batch.take(pa.array([i for i, _, _ in done], pa.int64()))
            made = [pa.array([f(t, r) for _, t, r in done], kind) for _, _, kind, f in said]
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *made], names=[*keep, *(n for n, *_ in said)])

    schema = T.StructType([*df.select(*keep).schema.fields, *(T.StructField(n, kind) for n, kind, *_ in said)])
    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)
