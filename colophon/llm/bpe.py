"""Exact BPE encoding and decoding with a lexicon of frequent words.

White space always ends a piece of the tokenizer's pre-tokenizer, so the ids of a text are those of its
words, one after the other. The words that are frequent in the corpus are encoded once and compiled
into a minimal acyclic automaton: equal suffixes are shared, and every transition carries how many
words come before it, so the path of a word adds up to its number, which leads to its ids. Tasks
memory-map the compiled file and send whole blocks of words through it in lockstep. Words that it
lacks are cut and merged exactly, all those of a block in lockstep as well. The merges lie in the same file.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from colophon.llm import arrays
from colophon.llm.columns import narrow
from colophon.session import _file_system, shared_folder

WORDS = 150_000
# Words are counted in pieces of so many bytes of text; a word counts towards the lexicon with the
# pieces in which it comes at least this often.
COUNTED, FREQUENT = 8 << 20, 2
LONGEST = 32
# Fixed value: how the supported tokenizer splits normalised text.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The symbol of a cell, and a rank above all ranks.
_SYMBOL, _UNMERGED = np.int64((1 << 20) - 1), np.int64(1 << 51)
# Kinds of bytes of lower-cased words of printable ASCII and Latin-1 letters, whose normal form and class
# need no Unicode tables: space, letter, digit, other.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[0x20], _KINDS[0x30:0x3A], _KINDS[0x61:0x7B], _KINDS[0x80:] = _SPACE, _DIGIT, _LETTER, _LETTER


class Merges:
    """The tokenizer's merges as a hash table over pairs of symbols."""

    BITS = 18
    ARRAYS = {"inner": "<i4", "last": "<i4", "keys": "<i8", "ranks": "<i4", "by_rank": "<i4", "surface_at": "<i4", "surfaces": "u1"}

    def __init__(self, path: str, parts: dict[str, np.ndarray] | None = None):
        """``parts`` are the arrays, if they are known; else they come from the tokenizer's file."""
        self.path, self._tokenizer = path, None
        self.parts = self._read(path) if parts is None else parts
        self.inner, self.last, self.keys, self.ranks, self.by_rank, self.surface_at, self.surfaces = (
            self.parts[name] for name in self.ARRAYS)

    def _read(self, path: str) -> dict[str, np.ndarray]:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, steps = spec["model"], spec["pre_tokenizer"].get("pretokenizers", [{}])
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if (model["type"], model.get("end_of_word_suffix"), model.get("continuing_subword_prefix"), kinds,
                steps[0].get("pattern", {}).get("Regex"), spec["decoder"]) != (
                "BPE", "</w>", None, ["NFC", "Replace", "Lowercase"], _SPLIT, None):
            raise ValueError(f"{path}: not a lower-casing BPE tokenizer with word ends")
        vocab = model["vocab"]
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        odd = iter(range(256, 512))
        shown = [chr(b if b in plain else next(odd)) for b in range(256)]
        surface = [b""] * (max(vocab.values()) + 1 + len(spec["added_tokens"]))
        for token, i in [*vocab.items(), *((t["content"], t["id"]) for t in spec["added_tokens"])]:
            surface[i] = token.encode()
        self.keys = np.full(1 << self.BITS, -1, np.int64)
        ranks, by_rank = np.full(len(self.keys), -1, np.int32), np.zeros(len(model["merges"]), np.int32)
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            key = vocab[a] << 20 | vocab[b]
            slot = self._slot(np.array([key], np.int64))[0]
            while self.keys[slot] >= 0:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], ranks[slot], by_rank[rank] = key, rank, vocab[a + b]
        # Decoding puts a space between surfaces, so each is held with one behind it.
        return {"inner": np.array([vocab[c] for c in shown], np.int32),
                "last": np.array([vocab[c + "</w>"] for c in shown], np.int32),
                "keys": self.keys, "ranks": ranks, "by_rank": by_rank,
                "surface_at": np.r_[0, np.cumsum([len(x) + 1 for x in surface])].astype(np.int32),
                "surfaces": np.frombuffer(b"".join(x + b" " for x in surface), np.uint8)}

    @property
    def tokenizer(self) -> Tokenizer:
        """The library's tokenizer, opened for the first word that needs it."""
        if self._tokenizer is None:
            self._tokenizer = Tokenizer.from_file(self.path)
            self._tokenizer.no_truncation()
            self._tokenizer.no_padding()
        return self._tokenizer

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The table slot of every pair, -1 where no merge takes it."""
        keys = a.astype(np.int64) << 20 | b
        slot = self._slot(keys)
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            held = self.keys[slot[open_]]
            hit = held == keys[open_]
            found[open_[hit]] = slot[open_[hit]]
            open_ = open_[~hit & (held >= 0)]
            slot[open_] = (slot[open_] + 1) % len(self.keys)
        return found

    def merge(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of 1 to ``LONGEST`` bytes, one after the other, and how many each has: the lowest merge
        of a piece, leftmost first, until none applies; all pieces of about a length take their steps together."""
        lengths = ends - starts
        counts = np.zeros(len(starts), np.int64)
        merged = []
        for low, high in ((1, 1), (2, 4), (5, 8), (9, 12), (13, 16), (17, 24), (25, LONGEST)):
            chosen = np.flatnonzero((lengths >= low) & (lengths <= high))
            for at in range(0, len(chosen), 50_000):
                part = chosen[at:at + 50_000]
                symbols, counts[part] = self._merge_block(data, starts[part], lengths[part], high)
                merged.append((part, symbols))
        after = np.cumsum(counts)
        ids = np.zeros(int(after[-1]) if len(after) else 0, np.int32)
        for part, symbols in merged:
            place = np.arange(symbols.shape[1])[None, :]
            held = place < counts[part][:, None]
            ids[((after - counts)[part][:, None] + place)[held]] = symbols[held]
        return ids, counts

    def _merge_block(self, data, starts, lengths, width) -> tuple[np.ndarray, np.ndarray]:
        """A cell holds a symbol and, above it, the rank of its merge with the next one, so the smallest cell of
        a piece is its next merge, the leftmost of equal ones."""
        columns = np.arange(width)
        raw = data[np.minimum(starts[:, None] + columns, len(data) - 1)]
        symbols, rows = self.inner[raw], np.arange(len(starts))
        symbols[rows, lengths - 1] = self.last[raw[rows, lengths - 1]]
        out, out_lengths, index = symbols, lengths.copy(), rows
        cells = symbols | _UNMERGED
        lengths = lengths.copy()

        def rank(r, c):
            """Fill in the merges of these cells with the cells behind them."""
            inside = (c >= 0) & (c + 1 < lengths[r])
            r, c = r[inside], c[inside]
            left = cells[r, c] & _SYMBOL
            slot = self.find(left, cells[r, c + 1] & _SYMBOL)
            cells[r, c] = np.where(slot >= 0, self.ranks[slot].astype(np.int64) << 20, _UNMERGED) | left

        rank(*np.nonzero(columns[None, :] + 1 < lengths[:, None]))
        while True:
            rows = np.arange(len(index))
            best = cells.argmin(axis=1)
            least = cells[rows, best]
            live = least < _UNMERGED
            if not live.all():
                done = index[~live]
                out[done], out_lengths[done] = cells[~live] & _SYMBOL, lengths[~live]
                cells, lengths, index, best, least = cells[live], lengths[live], index[live], best[live], least[live]
                rows = np.arange(len(index))
            if not len(index):
                return out, out_lengths
            # What stands behind the merged pair moves up; the cell before it may merge with the new one.
            take = np.minimum(columns[None, :] + (columns[None, :] > best[:, None]), width - 1)
            cells = np.take_along_axis(cells, take, axis=1)
            lengths = lengths - 1
            cells[rows, best] = self.by_rank[least >> 20] | _UNMERGED
            before = best - 1
            some = before >= 0
            cells[rows[some], before[some]] = (cells[rows[some], before[some]] & _SYMBOL) | _UNMERGED
            rank(np.r_[rows, rows], np.r_[best, before])

    def encode_spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words without white space, exactly as the tokenizer has them in any text: all ids, and
        where each word's begin and how many they are."""
        text, begins = _spaced(data, starts, ends)
        word_ends = begins + ends - starts
        first, word, odd = _pieces(text, begins)
        last = np.minimum(np.r_[first[1:], len(text)], word_ends[word]) if len(word) else first
        odd[word[last - first > LONGEST]] = True
        kept = ~odd[word]
        ids, counts = self.merge(text, first[kept], last[kept])
        own = np.bincount(word[kept], weights=counts, minlength=len(starts)).astype(np.int64)
        at = np.cumsum(own) - own
        others = []
        for i in np.flatnonzero(odd).tolist():
            raw = data[starts[i]:ends[i]].tobytes().decode()
            others.append(np.array(self.tokenizer.encode(raw, add_special_tokens=False).ids, np.int32))
            own[i] = len(others[-1])
        if others:
            at[odd] = len(ids) + np.cumsum(own[odd]) - own[odd]
            ids = np.concatenate([ids, *others])
        return ids, at, own

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of every word."""
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        starts = ends - np.array([len(w) for w in words], np.int64)
        ids, at, counts = self.encode_spans(data, starts, ends)
        return [ids[a:a + n] for a, n in zip(at.tolist(), counts.tolist())]

    def decode(self, ids: np.ndarray) -> bytes:
        """The surfaces of the ids with spaces between, as the tokenizer has no decoder."""
        begins = self.surface_at[ids].astype(np.int64)
        sizes = self.surface_at[ids + 1] - begins
        return self.surfaces[_positions(begins, sizes)].tobytes()[:-1]


def _positions(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``begins[0], begins[0] + 1, ...`` of every range of a size, one range after the other."""
    after = np.cumsum(sizes)
    return np.repeat(begins - (after - sizes), sizes) + np.arange(int(after[-1]) if len(after) else 0)


def _spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with a space behind each, and where they begin then."""
    sizes = ends - starts + 1
    after = np.cumsum(sizes)
    text = np.full(int(after[-1]) if len(after) else 0, 0x20, np.uint8)
    inside = np.ones(len(text), bool)
    inside[after - 1] = False
    text[inside] = data[_positions(starts, ends - starts)]
    return text, after - sizes


def _pieces(text: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case spaced words in place and cut them as the tokenizer does: where each piece begins, its
    word, and which words have characters that this does not know."""
    odd = np.zeros(len(begins), bool)
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), odd
    before, behind = np.r_[np.uint8(0x20), text[:-1]], np.r_[text[1:], np.uint8(0x20)]
    # Of what is beyond ASCII the letters that begin with C3 are known, but not the signs among them.
    strange = (text < 0x20) | (text == 0x7F) | ((text >= 0xC0) & (text != 0xC3)) | (
        (before == 0xC3) & ((text == 0x97) | (text == 0xB7))) | ((text == 0x3C) & (behind == 0x7C))
    odd[np.searchsorted(begins, np.flatnonzero(strange), side="right") - 1] = True
    text[((text >= 0x41) & (text <= 0x5A)) | ((before == 0xC3) & (text >= 0x80) & (text <= 0x9E))] += 0x20
    kind = _KINDS[text]
    kind_before = np.r_[np.uint8(_SPACE), kind[:-1]]
    start = (kind != _SPACE) & ((kind != kind_before) | (kind == _DIGIT))
    # Short forms 's 't 'm 'd 're 've 'll, where no other sign stands before them.
    mark = np.flatnonzero((text == 0x27) & (kind_before != _OTHER))
    one, two = text[mark + 1], text[np.minimum(mark + 2, len(text) - 1)]
    short = np.where(np.isin(one, np.frombuffer(b"stmd", np.uint8)), 2, np.where(
        (np.isin(one, np.frombuffer(b"rv", np.uint8)) & (two == 0x65)) | ((one == 0x6C) & (two == 0x6C)), 3, 0))
    mark, short = mark[short > 0], short[short > 0]
    start[mark + 1] = False
    start[mark + short] = kind[mark + short] != _SPACE
    first = np.flatnonzero(start)
    return first, np.searchsorted(begins, first, side="right") - 1, odd


def minimal_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of sorted, distinct words as a double array.

    From state ``s`` byte ``c`` leads over slot ``t = base[s] + c`` to ``target[t]`` if ``check[t] == s``;
    the ``add[t]`` of a word's path sum up to its place in the list, if ``final`` of its last state.
    """
    register: dict[tuple, int] = {}
    states: list[tuple] = []
    path: list[list] = [[False, []]]  # of the last word: is it an end, and (byte, state) so far

    def freeze(depth: int, previous: bytes):
        while len(path) - 1 > depth:
            end, edges = path.pop()
            key = (end, tuple(edges))
            state = register.get(key)
            if state is None:
                state = register[key] = len(states)
                states.append(key)
            path[-1][1].append((previous[len(path) - 1], state))

    previous = b""
    for word in words:
        common = 0
        while common < min(len(word), len(previous)) and word[common] == previous[common]:
            common += 1
        freeze(common, previous)
        path.extend([False, []] for _ in word[common:])
        path[-1][0] = True
        previous = word
    freeze(0, previous)
    states.append((path[0][0], tuple(path[0][1])))  # the start is the last state

    below = np.zeros(len(states), np.int64)  # a state comes after those it leads to
    for s, (end, edges) in enumerate(states):
        below[s] = end + sum(below[to] for _, to in edges)
    slots = sum(len(edges) for _, edges in states) * 2 + 1024
    base, final = np.zeros(len(states), np.int32), np.zeros(len(states), bool)
    check, target, add = np.full(slots, -1, np.int32), np.zeros(slots, np.int32), np.zeros(slots, np.int32)
    used, begin = bytearray(slots), {}
    for s, (end, edges) in sorted(enumerate(states), key=lambda x: -len(x[1][1])):
        final[s] = end
        if not edges:
            continue
        # The search goes on where the last state of as many edges was put.
        first, others = edges[0][0], [c - edges[0][0] for c, _ in edges[1:]]
        free = used.find(0, begin.get(len(edges), 256))
        while any(used[free + c] for c in others):
            free = used.find(0, free + 1)
        begin[len(edges)] = free
        at = free - first
        if at + 1024 >= len(used):
            grow = len(used)
            used.extend(bytes(grow))
            check = np.r_[check, np.full(grow, -1, np.int32)]
            target, add = np.r_[target, np.zeros(grow, np.int32)], np.r_[add, np.zeros(grow, np.int32)]
        base[s], before = at, int(end)
        for c, to in edges:
            used[at + c] = 1
            check[at + c], target[at + c], add[at + c] = s, to, before
            before += below[to]
    top = int(np.flatnonzero(check >= 0).max(initial=0)) + 257
    room = max(0, top - len(check))
    pad = lambda x, v: np.r_[x[:top], np.full(room, v, np.int32)]
    return {"base": base, "final": final.astype(np.int32), "check": pad(check, -1), "target": pad(target, 0),
            "add": pad(add, 0)}


_ARRAYS = {**dict.fromkeys(["base", "final", "check", "target", "add", "starts", "ids"], "<i4"), **Merges.ARRAYS}


def compiled(words: list[bytes], merges: Merges) -> bytes:
    """The lexicon as one file: sizes, then the arrays of the automaton, offsets and ids of the words, and the
    merges, each from a multiple of eight bytes on."""
    words = sorted(set(words))
    parts = minimal_automaton(words) | merges.parts
    ids = merges.encode_words(words)
    parts["starts"] = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
    parts["ids"] = np.concatenate([*ids, np.zeros(0, np.int32)])
    content = [np.ascontiguousarray(parts[n], kind).tobytes() for n, kind in _ARRAYS.items()]
    return struct.pack(f"<{len(_ARRAYS)}q", *map(len, content)) + b"".join(x + bytes(-len(x) % 8) for x in content)


class Encoder:
    """Encodes texts with a memory-mapped lexicon and exact merges for the rest."""

    _open: dict[tuple[str, str], Encoder] = {}

    def __init__(self, path: str, lexicon: str):
        mapped = np.memmap(lexicon, dtype=np.uint8, mode="r")
        at = 8 * len(_ARRAYS)
        parts = {}
        for (name, kind), size in zip(_ARRAYS.items(), struct.unpack(f"<{len(_ARRAYS)}q", bytes(mapped[:at]))):
            parts[name] = mapped[at:at + size].view(kind).view(np.ndarray)
            at += size + -size % 8
        self.merges = Merges(path, parts)
        self.base, self.final, self.check, self.target, self.add, self.starts, self.ids = (
            parts[n] for n in list(_ARRAYS)[:7])
        self.words = len(self.starts) - 1

    @classmethod
    def of(cls, path: str, lexicon: str) -> Encoder:
        """The encoder of this worker process; another lexicon replaces it."""
        if (path, lexicon) not in cls._open:
            cls._open = {(path, lexicon): cls(path, SparkFiles.get(lexicon))}
        return cls._open[path, lexicon]

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of every word in the lexicon, -1 for a word that it lacks."""
        out = np.full(len(starts), -1, np.int64)
        if not self.words:
            return out
        state = np.full(len(starts), len(self.base) - 1, np.int32)
        total = np.zeros(len(starts), np.int32)
        which, at, stop = np.arange(len(starts)), starts.copy(), ends
        while len(which):
            slot = self.base[state] + data[at]
            good = self.check[slot] == state
            if not good.all():
                which, at, stop, slot, total = which[good], at[good], stop[good], slot[good], total[good]
            state, total = self.target[slot], total + self.add[slot]
            at = at + 1
            done = at == stop
            if done.any():
                ended = done & (self.final[state] == 1)
                out[which[ended]] = total[ended]
                more = ~done
                which, at, stop, state, total = which[more], at[more], stop[more], state[more], total[more]
        return out

    def _block(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = arrays.word_bounds(data, at)
        numbers = self.numbers(data, starts, ends)
        known = numbers >= 0
        counts = np.zeros(len(numbers), np.int64)
        counts[known] = self.starts[numbers[known] + 1] - self.starts[numbers[known]]
        merged, begins, counts[~known] = self.merges.encode_spans(data, starts[~known], ends[~known])
        per_word = np.r_[0, np.cumsum(counts)]
        ids = np.empty(per_word[-1], np.int32)
        ids[_positions(per_word[:-1][known], counts[known])] = self.ids[_positions(
            self.starts[numbers[known]].astype(np.int64), counts[known])]
        ids[_positions(per_word[:-1][~known], counts[~known])] = merged[_positions(begins, counts[~known])]
        return ids, per_word[np.searchsorted(starts, at)]

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(first row, last row + 1, ids, offsets of the rows' ids)``, block by block."""
        data, offsets = arrays.text_buffers(texts)
        for row, end in arrays.blocks(offsets):
            part = data[offsets[row]:offsets[end]]
            if end == row + 1 and len(part) > 2 * arrays.BLOCK:
                ids = [self._block(p, np.array([0, len(p)]))[0] for p in arrays.long_parts(part)]
                ids = np.concatenate(ids)
                yield row, end, ids, np.array([0, len(ids)])
            else:
                yield row, end, *self._block(part, offsets[row:end + 1] - offsets[row])


def _often(data: np.ndarray, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """The words that come ``FREQUENT`` times or more in some blocks, with their numbers."""
    hashes, starts, ends = map(np.concatenate, zip(*parts))
    _, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    often = (counts >= FREQUENT) & (ends[first] - starts[first] <= 2 * LONGEST)
    first, counts = first[often], counts[often]
    words = [data[i:j].tobytes() for i, j in zip(starts[first].tolist(), ends[first].tolist())]
    return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts)], names=["word", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrays.batches_of(batches):
        data, offsets = arrays.text_buffers(batch.column("text"))
        parts, size = [], 0
        for row, end in arrays.blocks(offsets):
            part, base = data[offsets[row]:offsets[end]], offsets[row]
            starts, ends = arrays.word_bounds(part, offsets[row:end + 1] - base)
            parts.append((arrays.word_hashes(part, starts, ends), starts + base, ends + base))
            size += len(part)
            if size >= COUNTED:
                yield _often(data, parts)
                parts, size = [], 0
        if parts:
            yield _often(data, parts)


def frequent_words(docs: DataFrame, words: int = WORDS) -> list[bytes]:
    """The most frequent words of all texts; at most ``words`` of them reach the driver.

    Pieces of text leave out the words they have fewer than ``FREQUENT`` times. That only decides
    which words are compiled: ids do not depend on it.
    """
    counted = docs.select("text").mapInArrow(_count_words, "word binary, n long")
    top = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(words)
    return [bytes(w) for w in top.toPandas()["word"]]


def ship(spark: SparkSession, content: bytes) -> str:
    """Put a file into the shared folder, have Spark bring it to every executor, return its name."""
    name = f"lexicon-{uuid.uuid4().hex}"
    files, where = _file_system(spark, f"{shared_folder(spark)}/{name}")
    stream = files.create(where)
    stream.write(content)
    stream.close()
    files.deleteOnExit(where)
    spark.sparkContext.addFile(where.toString())
    return name


def lexicon(docs: DataFrame, path: str, words: int = WORDS) -> str:
    """Compile the frequent words of ``docs`` and ship them."""
    return ship(docs.sparkSession, compiled(frequent_words(docs, words), Merges(path)))


def encode(docs: DataFrame, path: str, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded`` of every row.

    ``path`` names the tokenizer's file on every machine. A null text is empty and has no ids.
    Repeated rows give repeated results, an empty table an empty one; extra columns are ignored.
    """
    docs = narrow(docs, "doc_id", "text")
    file = lexicon(docs, path, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path, file)
        for batch in arrays.batches_of(batches):
            doc_ids = batch.column("doc_id")
            for row, end, ids, at in encoder.encode(batch.column("text")):
                rows = range(end - row)
                yield pa.RecordBatch.from_arrays([
                    doc_ids.slice(row, end - row),
                    pa.array([ids[at[r]:at[r + 1]].astype("<u4").tobytes() for r in rows], pa.binary()),
                    pa.array([encoder.merges.decode(ids[at[r]:at[r + 1]]) for r in rows], pa.string()),
                ], names=["doc_id", "ids", "decoded"])

    return docs.mapInArrow(run, "doc_id long, ids binary, decoded string")
