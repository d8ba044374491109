"""Byte-pair encoding and decoding through a minimal acyclic transducer lexicon.

``Lexicon`` is one flat file: the vocabulary and merge tables of a public tokenizer, plus an
automaton of the corpus's frequent words. The automaton shares prefixes and suffixes (it is
minimal); integers on its arcs add up to the word's ordinal, and the ordinal points at the word's
token ids. Executors map the file into memory, so that the Python workers of a machine share it.

A word that the automaton does not hold is merged exactly: lowest rank first, then leftmost, until
no pair has a rank. So the lexicon's size (``LEXICON_WORDS``, a parameter) changes the speed and
never the ids.

Defined results: a null or empty text has no tokens and decodes to empty text. The texts of special
tokens inside a document become their ids, as the tokenizers library does it by default. Decoding
joins the token strings by one space, since this tokenizer's file names no decoder. A text of any
length is encoded whole. Columns other than the key and the text are not read, whatever their names;
an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import itertools
import json
import os
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.session import write_table

TOKENIZER = "word_bpe_49k.json"
LEXICON_WORDS = 1 << 16
NO_RANK = np.int32(2**31 - 1)
LONG_WORD = 200  # bytes; longer words are merged by a heap, not in the vectorised rounds
COUNTED_WORDS = 250_000  # words that a task counts before it passes them on
CACHE_BYTES = 48 << 20  # of resolved words in a worker, about, before its cache starts anew
WORD_BYTES = 150  # what a word in the cache takes besides its letters, about


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---------------------------------------------------------------- words of a text

def _char_class(kind: str, limit: int) -> str:
    return "".join(re.escape(chr(c)) for c in range(limit) if unicodedata.category(chr(c))[0] == kind)


class Words:
    """Splits a text into the tokenizer's words (normalised strings; specials as ids).

    Texts of code points below U+0180 take a compiled pattern: composing does not change them and
    lower case is per character there (but for U+0130). Any other text goes through the
    normaliser and splitter that the tokenizer's own file names.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters, numbers = _char_class("L", 0x180), _char_class("N", 0x180)
        # the tokenizer file's own pattern, with its classes spelled out for these code points; letters
        # come first, since they are the commonest and no other alternative begins with one
        self.find = re.compile(
            rf"[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d|[{numbers}]|[^\t-\r \x85\xa0{letters}{numbers}]+").findall
        self.find_ascii = re.compile(r"[a-z]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\t-\r a-z0-9]+").findall
        self.plain = re.compile("[\0-įı-ſ]*").fullmatch
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.byte_of = {c: b for b, c in enumerate(byte_chars())}

    def __call__(self, text: str) -> list[str | int]:
        if "<|" in text and (parts := self.cut.split(text))[1:]:
            return [w for p in parts for w in ([self.special[p]] if p in self.special else self.words(p))]
        return self.words(text)

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return self.find_ascii(text.lower())
        if self.plain(text):
            return self.find(text.lower())
        text = self.tok.normalizer.normalize_str(text)
        # the splitter maps bytes to printable characters; map them back
        return [bytes(map(self.byte_of.__getitem__, w)).decode("utf-8")
                for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(text)]


def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes
    stand for themselves, the others for the code points from 256 on."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


# ---------------------------------------------------------------- merge tables and exact merging

def merge_tables(path: str) -> dict[str, np.ndarray]:
    spec = json.load(open(path, encoding="utf-8"))
    vocab = spec["model"]["vocab"]
    tail = spec["model"].get("end_of_word_suffix") or ""
    chars = byte_chars()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    key = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
    order = np.argsort(key, kind="stable")
    names = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    strings = [names.get(i, "").encode() for i in range(max(names) + 1)]
    return {"pair": key[order], "rank": order.astype(np.int32),
            "made": np.array([vocab[a + b] for a, b in pairs], np.int32),
            "inner": np.array([vocab[c] for c in chars], np.int32),
            "final": np.array([vocab[c + tail] for c in chars], np.int32),
            "name_at": np.cumsum([0, *map(len, strings)]).astype(np.int64),
            "name": np.frombuffer(b"".join(strings), np.uint8)}


def merge_long(word: bytes, t: dict[str, np.ndarray]) -> np.ndarray:
    """Exact merging of one long word: a heap of (rank, position) over a linked list."""
    sym = t["inner"][np.frombuffer(word, np.uint8)].tolist()
    sym[-1] = int(t["final"][word[-1]])
    ranks: dict[int, int] = {}

    def rank(a: int, b: int) -> int:
        k = a << 20 | b
        if k not in ranks:
            p = int(np.searchsorted(t["pair"], k))
            ranks[k] = int(t["rank"][p]) if p < len(t["pair"]) and t["pair"][p] == k else -1
        return ranks[k]

    n = len(sym)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := rank(sym[i], sym[i + 1])) >= 0]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        j = nxt[i]
        if sym[i] < 0 or j >= n or rank(sym[i], sym[j]) != r:
            continue
        sym[i], sym[j], nxt[i] = int(t["made"][r]), -1, nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
            if (q := rank(sym[i], sym[nxt[i]])) >= 0:
                heapq.heappush(heap, (q, i))
        if prv[i] >= 0 and (q := rank(sym[prv[i]], sym[i])) >= 0:
            heapq.heappush(heap, (q, prv[i]))
    return np.array([s for s in sym if s >= 0], np.int32)


def merge_words(words: list[bytes], t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Exact merging of many non-empty words at once: each round does, in every word, the leftmost
    merge of lowest rank. Returns (ids, offsets)."""
    n = len(words)
    length = np.fromiter(map(len, words), np.int64, n)
    out_sym, out_word = [], []
    for i in np.flatnonzero(length > LONG_WORD):
        ids = merge_long(words[i], t)
        out_sym.append(ids)
        out_word.append(np.full(len(ids), i))
    short = np.flatnonzero(length <= LONG_WORD)
    sym = t["inner"][np.frombuffer(b"".join([words[i] for i in short]), np.uint8)]
    if len(sym):
        ends = np.cumsum(length[short])
        raw = np.fromiter((words[i][-1] for i in short), np.int64, len(short))
        sym[ends - 1] = t["final"][raw]
        wid = np.repeat(short, length[short])
        while len(sym):
            key = sym[:-1].astype(np.int64) << 20 | sym[1:]
            at = np.minimum(np.searchsorted(t["pair"], key), len(t["pair"]) - 1)
            r = np.full(len(sym), NO_RANK)
            good = (t["pair"][at] == key) & (wid[:-1] == wid[1:])
            r[:-1][good] = t["rank"][at[good]]
            start = np.flatnonzero(np.concatenate([[True], wid[1:] != wid[:-1]]))
            least = np.minimum.reduceat(r, start)
            per = np.repeat(least, np.diff(np.append(start, len(sym))))
            over = per == NO_RANK
            out_sym.append(sym[over])
            out_word.append(wid[over])
            hit = np.flatnonzero((r == per) & ~over)
            if not len(hit):
                break
            hit = hit[np.concatenate([[True], wid[hit][1:] != wid[hit][:-1]])]
            sym[hit] = t["made"][r[hit]]
            keep = ~over
            keep[hit + 1] = False
            sym, wid = sym[keep], wid[keep]
    if not out_sym:
        return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
    word = np.concatenate(out_word)
    order = np.argsort(word, kind="stable")
    return np.concatenate(out_sym)[order], np.concatenate([[0], np.cumsum(np.bincount(word, minlength=n))])


# ---------------------------------------------------------------- the automaton

def automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """Minimal acyclic automaton of sorted distinct words. The numbers on the arcs of a word's path
    add up to its ordinal."""
    known: dict[tuple, int] = {}
    counts: list[int] = []  # words accepted from each state

    def freeze(final: bool, arcs: list[tuple[int, int]]) -> int:
        k = (final, tuple(arcs))
        if k not in known:
            known[k] = len(counts)
            counts.append(final + sum(counts[s] for _, s in arcs))
        return known[k]

    path: list[list] = [[False, []]]  # open states of the last word: [final, frozen arcs]
    last = b""
    for w in words:
        same = len(os.path.commonprefix([last, w]))
        for i in range(len(last), same, -1):
            state = freeze(*path.pop())
            path[-1][1].append((last[i - 1], state))
        path += [[False, []] for _ in range(len(w) - same)]
        path[-1][0] = True
        last = w
    for i in range(len(last), 0, -1):
        state = freeze(*path.pop())
        path[-1][1].append((last[i - 1], state))
    root = freeze(*path.pop())
    key, target, add, ends = [], [], [], np.zeros(len(counts), bool)
    for (final, arcs), s in known.items():
        ends[s], before = final, int(final)
        for label, to in arcs:
            key.append(s << 8 | label)
            target.append(to)
            add.append(before)
            before += counts[to]
    order = np.argsort(np.array(key, np.int64))
    return {"arc": np.array(key, np.int64)[order], "to": np.array(target, np.int32)[order],
            "add": np.array(add, np.int32)[order], "ends": ends, "root": np.array([root], np.int32)}


def ordinals(words: list[bytes], t: dict[str, np.ndarray]) -> np.ndarray:
    """The ordinal of each word in the automaton, or -1."""
    n = len(words)
    length = np.fromiter(map(len, words), np.int64, n)
    buf = np.frombuffer(b"".join(words), np.uint8)
    first = np.cumsum(length) - length
    state = np.full(n, t["root"][0], np.int64)
    total = np.zeros(n, np.int64)
    live, step = np.flatnonzero(length > 0), 0
    state[length == 0] = -1
    while len(live) and len(t["arc"]):
        key = state[live] << 8 | buf[first[live] + step]
        at = np.minimum(np.searchsorted(t["arc"], key), len(t["arc"]) - 1)
        ok = t["arc"][at] == key
        state[live] = np.where(ok, t["to"][at], -1)
        total[live] += np.where(ok, t["add"][at], 0)
        step += 1
        live = live[ok & (length[live] > step)]
    if not len(t["arc"]):
        return np.full(n, -1)
    return np.where((state >= 0) & t["ends"][state], total, -1)


# ---------------------------------------------------------------- the lexicon file

def write_lexicon(file: str, arrays: dict[str, np.ndarray]) -> None:
    head, at, body = {}, 0, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        head[name] = [a.dtype.str, len(a), at]
        raw += b"\0" * (-len(raw) % 16)
        body.append(raw)
        at += len(raw)
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 16)
    with open(file, "wb") as f:
        f.write(len(text).to_bytes(8, "little") + text + b"".join(body))


def map_lexicon(file: str) -> dict[str, np.ndarray]:
    whole = np.memmap(file, np.uint8, "r")
    n = int.from_bytes(whole[:8].tobytes(), "little")
    head = json.loads(whole[8: 8 + n].tobytes())
    return {k: np.frombuffer(whole, np.dtype(d), size, 8 + n + at) for k, (d, size, at) in head.items()}


def count_words(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(word, n): how often the tokenizer's words occur in all texts. Tasks send partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = Words(path), Counter()

        def rows() -> pa.RecordBatch:
            out = pa.record_batch({"word": pa.array(list(seen), pa.string()),
                                   "n": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return out

        for b in batches:
            for x in b.column(0):
                seen.update(w for w in split(x.as_py() or "") if w.__class__ is str)
                if len(seen) > COUNTED_WORDS:
                    yield rows()
        yield rows()

    return docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, size: int) -> list[str]:
    """At most ``size`` words: all whose count lies in the highest steps (sixteenths of an octave)
    that together fit. A histogram of at most a thousand steps decides it, so that tasks send no
    candidates of their own to the driver."""
    step = F.floor(F.log2("n") * 16).cast("int")
    histogram = sorted(((r.step, r.c) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("c")).collect()), reverse=True)
    total, cut = 0, None
    for at, c in histogram:
        total += c
        if total > size:
            break
        cut = at
    if cut is None:
        return []
    return [r.word for r in counts.where(step >= cut).select("word").collect()]


def build_lexicon(spark: SparkSession, docs: DataFrame, path: str | None = None,
                  size: int = LEXICON_WORDS, text: str = "text") -> str:
    """Compile the most frequent words of all texts, ``size`` at most, and hand the file to every
    executor. Returns the file's name for ``Encoder``. Only those words reach the driver."""
    path = path or tokenizer_path()
    words = sorted(w.encode() for w in frequent_words(write_table(count_words(docs, path, text), "word-counts"), size))
    t = merge_tables(path)
    ids, at = merge_words(words, t)
    fd, file = tempfile.mkstemp(prefix="lexicon-", suffix=".bin")
    os.close(fd)
    write_lexicon(file, t | automaton(words) | {"ids": ids, "ids_at": at})
    spark.sparkContext.addFile(file)
    return os.path.basename(file)


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts[i]`` values from ``starts[i]`` on, for every i in turn."""
    total = int(counts.sum())
    return values[np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(total)]


class Slots(dict):
    """Numbers words in the order of their first look-up; ``new`` holds those not yet resolved."""

    def __init__(self):
        super().__init__()
        self.new: list[str | int] = []

    def __missing__(self, word: str | int) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class WordIds:
    """Token ids of many texts: each distinct word is resolved once per worker and cache life."""

    def __init__(self, path: str):
        self.split = Words(path)
        self.clear()

    def clear(self) -> None:
        self.slot = Slots()
        self.at = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.uses = np.zeros(0, np.int64)  # look-ups of each word
        self.held = 0  # bytes of the words held, about

    def shrink(self) -> None:
        """Keep the words looked up most often, of at most half the bytes."""
        words = list(self.slot)
        size = WORD_BYTES + np.fromiter((len(w) if w.__class__ is str else 0 for w in words), np.int64, len(words))
        order = np.argsort(-self.uses, kind="stable")
        order = np.sort(order[np.cumsum(size[order]) <= CACHE_BYTES // 2])
        slot, starts, counts = Slots(), self.at[:-1][order], np.diff(self.at)[order]
        slot.update(zip([words[i] for i in order.tolist()], range(len(order)), strict=True))
        self.slot, self.ids, self.at = slot, gather(self.ids, starts, counts), np.concatenate([[0], np.cumsum(counts)])
        self.uses, self.held = self.uses[order], int(size[order].sum())

    def resolve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of all texts."""
        if self.held > CACHE_BYTES:
            self.shrink()
        split = self.split
        lists = [split(x) if x else [] for x in texts]
        n = np.fromiter(map(len, lists), np.int64, len(lists))
        slots = np.fromiter(map(self.slot.__getitem__, itertools.chain.from_iterable(lists)), np.int64, int(n.sum()))
        del lists
        if self.slot.new:
            self.held += sum(WORD_BYTES + len(w) if w.__class__ is str else WORD_BYTES for w in self.slot.new)
            self.learn(self.slot.new)
            self.slot.new = []
        uses = np.bincount(slots, minlength=len(self.slot))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        counts = self.at[slots + 1] - self.at[slots]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return gather(self.ids, self.at[slots], counts), ends[np.concatenate([[0], np.cumsum(n)])]

    def learn(self, words: list[str | int]) -> None:
        """Append the ids of new words, in their order; the ids of special tokens stand for themselves."""
        strings = [w for w in words if w.__class__ is str]
        ids, at = self.resolve(strings) if strings else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        if len(strings) < len(words):
            start, count, extra, k = [], [], [], 0
            for w in words:
                if w.__class__ is str:
                    start.append(at[k])
                    count.append(at[k + 1] - at[k])
                    k += 1
                else:
                    start.append(len(ids) + len(extra))
                    count.append(1)
                    extra.append(w)
            ids = gather(np.concatenate([ids, np.array(extra, np.int32)]), np.array(start), np.array(count))
            at = np.concatenate([[0], np.cumsum(count)])
        self.ids = np.concatenate([self.ids, ids])
        self.at = np.concatenate([self.at, self.at[-1] + at[1:]])


_KEPT: dict[tuple, WordIds] = {}


def kept(kind: type, *args) -> WordIds:
    """One encoder per worker process and parameters: its cache outlives a task."""
    key = (kind, *args)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = kind(*args)
    return _KEPT[key]


class Encoder(WordIds):
    """Words from the mapped automaton, the rest by exact merging."""

    def __init__(self, path: str, lexicon: str):
        super().__init__(path)
        self.t = map_lexicon(lexicon if os.path.isabs(lexicon) else SparkFiles.get(lexicon))

    def resolve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        t, raw = self.t, [w.encode() for w in words]
        at = ordinals(raw, t)
        held = np.flatnonzero(at >= 0)
        rest = np.flatnonzero(at < 0)
        more, more_at = merge_words([raw[i] for i in rest], t)
        ids = np.concatenate([t["ids"], more])
        start, count = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
        start[held], count[held] = t["ids_at"][at[held]], t["ids_at"][at[held] + 1] - t["ids_at"][at[held]]
        start[rest], count[rest] = len(t["ids"]) + more_at[:-1], np.diff(more_at)
        return gather(ids, start, count), np.concatenate([[0], np.cumsum(count)])

    def decode(self, ids: np.ndarray) -> bytes:
        if not hasattr(self, "names"):
            at, raw = self.t["name_at"], self.t["name"].tobytes()
            self.names = [raw[a:b] for a, b in itertools.pairwise(at.tolist())]
        names = self.names
        return b" ".join([names[i] for i in ids.tolist()])


def text_pieces(col: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a column in lists of a bounded number of bytes."""
    _, off = C.text_buffers(col)
    for i, j in C.pieces(off):
        yield col.slice(i, j - i).to_pylist()


def encode_decode(docs: DataFrame, lexicon: str, path: str | None = None, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(key, ids, decoded): the token ids of each text as little-endian unsigned 32-bit integers in
    one binary value, and the text that these ids decode to. One row per input row, in one pass
    without a shuffle."""
    path = path or tokenizer_path()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = kept(Encoder, path, lexicon)
        for b in batches:
            done = 0
            for texts in text_pieces(b.column(1)):
                ids, at = enc.encode(texts)
                raw, bounds = ids.astype("<u4"), at.tolist()
                yield pa.record_batch({
                    "k": b.column(0).slice(done, len(texts)),
                    "ids": pa.array([raw[i:j].tobytes() for i, j in itertools.pairwise(bounds)], pa.binary()),
                    "decoded": pa.array([enc.decode(ids[i:j]).decode() for i, j in itertools.pairwise(bounds)], pa.string())})
                done += len(texts)
        enc.clear()  # the worker idles, or serves another stage, without the words of this task

    return docs.select(F.col(key).alias("k"), text).mapInArrow(run, f"k {kind}, ids binary, decoded string") \
        .withColumnRenamed("k", key)


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    out = encode_decode(docs, build_lexicon(spark, docs))
    return digests(out)


def digests(out: DataFrame) -> DataFrame:
    return out.select("doc_id", F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
