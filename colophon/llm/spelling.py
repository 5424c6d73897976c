"""Spelling variants: words one edit apart, found through an index of variable-length grams.

1. How many words hold each gram of two to six characters is counted. The frequent grams are the
   dictionary's inner nodes: a gram that is frequent is extended by the next character, one that is not
   is never extended, so the dictionary has no gram below an infrequent one.
2. A word between two marks is decomposed: every place has the shortest gram from there on that is no
   longer frequent. Where a gram ends depends on its own characters alone. Grams of the left half
   are known by their distance from the start, those of the right half by that from the end.
3. An edit at a place affects the left grams that end there or later and the right grams that start
   there or before. The most that any edit affects, ``affected``, bounds what two words one edit
   apart share from below. With all grams in one global order, the rarest first, two such words share
   one of their first ``affected + 1`` grams, and two of their first ``affected + 2``. So only these few lists
   of a word are merged; a list that would be long is split by the second gram that must be shared.
4. What meets in a list is compared exactly.

Words of n characters meet those of n and n + 1 in the class n, whose grams are at most half as long as
its shorter words, so that an edit always leaves three grams or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from colophon.llm.arrays import batches_of, text_buffers
from colophon.llm.columns import narrow, whole
from colophon.llm.licenses import LOWER, UPPER
from colophon.session import Scratch

RUN = "[A-Za-z\\u00C0-\\u00FF]"
SHORTEST, OFTEN = 5, 3
SLIP = 97
# Lengths of grams; a gram of more than FREQUENT words is extended, the DICTIONARY most frequent ones at most.
LEAST, LONGEST = 2, 6
FREQUENT, DICTIONARY = 32, 1 << 16
# Grams of a half that are used, from the word's end inwards.
PLACES = 12
# A list of a gram that more words than this hold is split by the second gram.
COMMON = 2000
# So many pairs of words are compared at a time.
PAIRS = 1 << 18
BEGIN, END = "\x02", "\x03"


def slipped(run: Column, doc_id: Column) -> Column:
    """The run, or where 97 divides the checksum of document and run, the run with one character less."""
    sum_of = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    place = (sum_of % F.length(run)).cast("int")
    return F.when(sum_of % SLIP == 0, F.concat(F.substring(run, F.lit(1), place), F.substr(run, place + 2))).otherwise(run)


def words_of(docs: DataFrame) -> DataFrame:
    """``word, n``: the words of all texts that come often enough, and how often."""
    docs = narrow(docs, "doc_id", "text")
    # Shorter runs give no word.
    runs = F.regexp_extract_all(whole(), F.lit(f"{RUN}{{{SHORTEST},}}"), F.lit(0))
    each = docs.select("doc_id", F.explode(runs).alias("run")).select(
        slipped(F.translate("run", UPPER, LOWER), F.col("doc_id")).alias("word"))
    counted = each.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("n") >= OFTEN) & (F.length("word") >= SHORTEST))


def frequent_grams(words: DataFrame, frequent: int = FREQUENT, size: int = DICTIONARY) -> tuple[dict[str, int], int]:
    """The frequent grams and how many times words hold them; and what no other gram exceeds. Those shorter
    than ``LONGEST`` are extended.

    Counted where grams are used, so of a long word only in its two ends. At most ``size`` grams reach
    the driver, those most often held.
    """
    end = PLACES + LONGEST
    ends = F.when(F.length("word") <= 2 * end, F.array(F.concat(F.lit(BEGIN), "word", F.lit(END)))).otherwise(
        F.array(F.concat(F.lit(BEGIN), F.left("word", F.lit(end))), F.concat(F.right("word", F.lit(end)), F.lit(END))))
    marked = words.select(F.explode(ends).alias("w"))
    grams = F.flatten(F.transform(F.sequence(F.lit(LEAST), F.lit(LONGEST)), lambda q: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("w") - q + 1, F.lit(1))), lambda i: F.substr("w", i, q))))
    counts = marked.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    top = counts.filter(F.col("n") > frequent).orderBy(F.desc("n"), "gram").limit(size).collect()
    return {r["gram"]: r["n"] for r in top}, top[-1]["n"] if len(top) == size else frequent


def gram_at(marked: str, start: int, most: int, frequent: dict[str, int]) -> str:
    """The shortest gram from a place on that is not frequent, of at most ``most`` characters."""
    end = start + LEAST
    while end < len(marked) and end - start < most and marked[start:end] in frequent:
        end += 1
    return marked[start:end]


def decomposed(word: str, kind: int, frequent: dict[str, int]) -> tuple[list[tuple[int, str, int, int]], int]:
    """The grams ``(frequency, key, first place, last place)`` of a word in the class of length ``kind``, in
    the global order, and how many an edit affects at most."""
    marked = BEGIN + word + END
    most = min(LONGEST, (kind + 2) // 2)
    left = min(PLACES, (kind + 1) // 2)
    right = min(PLACES, kind + 1 - left)
    grams = []
    for start in range(left):
        gram = gram_at(marked, start, most, frequent)
        grams.append((frequent.get(gram, 0), f"{kind}<{start}{gram}", start, start + len(gram) - 1))
    ends = [end for *_, end in grams]
    first_right = len(marked) - 1 - right
    for back in range(right):
        start = first_right + back
        gram = gram_at(marked, start, most, frequent)
        grams.append((frequent.get(gram, 0), f"{kind}>{len(marked) - start}{gram}", start, start + len(gram) - 1))
    # Between the halves' grams nothing changes, so the places where grams end or start are enough.
    places = [p for p in {*(e + d for e in ends for d in (0, 1)), *range(first_right - 1, len(marked))} if 0 < p < len(marked) - 1]
    kept = min(sum(e < p for e in ends) + min(right, max(0, len(marked) - 2 - max(p, first_right - 1))) for p in places)
    return sorted(grams), len(grams) - kept


def list_keys(word: str, kind: int, frequent: dict[str, int], unseen: int, common: int = COMMON) -> list[str]:
    """The lists of a class that a word is in."""
    grams, affected = decomposed(word, kind, frequent)
    keys = []
    for i, (n, key, *_) in enumerate(grams[:affected + 1]):
        if max(n, 0 if n else unseen) <= common:
            keys.append(key)
        else:
            keys += [key + second for _, second, *_ in grams[i + 1:affected + 2]]
    return keys


def _lists(words: DataFrame, frequent: dict[str, int], unseen: int, common: int) -> DataFrame:
    """``key, longer, word, n``: every word in its lists, as one of the class's shorter words and in the
    class below as a longer one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            for part in range(0, batch.num_rows, 2000):
                out: list[tuple] = []
                block = batch.slice(part, 2000)
                for word, n in zip(block.column("word").to_pylist(), block.column("n").to_pylist()):
                    for longer in (False, True):
                        kind = len(word) - longer
                        if kind >= SHORTEST:
                            out += [(key, longer, word, n) for key in list_keys(word, kind, frequent, unseen, common)]
                columns = list(zip(*out)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    columns, (pa.string(), pa.bool_(), pa.string(), pa.int64()))], names=["key", "longer", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key string, longer boolean, word string, n long")


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The first 16 characters of every word as two 64-bit numbers, the first character lowest, and all
    words' lengths. Characters of words are below 256."""
    data, offsets = text_buffers(words)
    after = np.r_[data[1:], np.zeros(min(1, len(data)), np.uint8)]
    begins = (data & 0xC0) != 0x80
    letters = np.where(data < 0x80, data, ((data & 3) << 6) | (after & 63)).astype(np.uint8)[begins]
    before = np.r_[0, np.cumsum(begins)][offsets]
    lengths = np.diff(before)
    place = np.arange(len(letters)) - np.repeat(before[:-1], lengths)
    held = place < 16
    out = np.zeros((len(words), 16), np.uint8)
    out[np.repeat(np.arange(len(words)), lengths)[held], place[held]] = letters[held]
    return out.view("<u8"), lengths


def one_edit(a: str, b: str) -> bool:
    """Whether ``b``, as long as ``a`` or one longer, differs by one replaced or one inserted character."""
    low, high = 0, len(a)
    while low < high:  # what both begin with, by halving
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return a != b and a[low + len(a) + 1 - len(b):] == b[low + 1:]


def _differ_once(letters: np.ndarray, longer: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``one_edit`` of pairs of words of at most 16 characters; ``longer`` says if the second is."""
    def bytes_set(x: np.ndarray) -> np.ndarray:
        for shift in (4, 2, 1):
            x = x | (x >> np.uint64(shift))
        return x & np.uint64(0x0101010101010101)

    one, all_bits = np.uint64(1), ~np.uint64(0)
    a, b = letters[i], letters[j]
    low, high = bytes_set(a[:, 0] ^ b[:, 0]), bytes_set(a[:, 1] ^ b[:, 1])
    replaced = ((low == 0) | (high == 0)) & ((low & (low - one)) == 0) & ((high & (high - one)) == 0) & ((low | high) != 0)
    # Where the first difference is, the longer word has one more; behind it, all moves up by one.
    same_low = np.where(low != 0, (low & (~low + one)) - one, all_bits)
    same_high = np.where(low != 0, np.uint64(0), (high & (~high + one)) - one)
    moved_low = (b[:, 0] >> np.uint64(8)) | (b[:, 1] << np.uint64(56))
    inserted = (((a[:, 0] ^ moved_low) & ~same_low) == 0) & (((a[:, 1] ^ (b[:, 1] >> np.uint64(8))) & ~same_high) == 0)
    return np.where(longer, inserted, replaced)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the words of every list. Rows are ordered by key, the class's shorter words first; the
    last list of a batch may go on in the next."""
    held: pa.Table | None = None

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, words = rows.column("key").combine_chunks(), rows.column("word").combine_chunks()
        longer = rows.column("longer").combine_chunks().to_numpy(zero_copy_only=False)
        n = rows.column("n").combine_chunks().to_numpy()
        starts = np.r_[0, np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)) + 1]
        ends = np.repeat(np.r_[starts[1:], len(keys)], np.diff(np.r_[starts, len(keys)]))
        letters, lengths = _letters(words)
        first = np.flatnonzero(~longer)
        counts = ends[first] - first - 1
        done = np.r_[0, np.cumsum(counts)]
        at = 0
        while at < len(first):
            to = max(at + 1, int(np.searchsorted(done, done[at] + PAIRS, side="right")) - 1)
            own = counts[at:to]
            i = np.repeat(first[at:to], own)
            j = i + 1 + np.arange(len(i)) - np.repeat(done[at:to] - done[at], own)
            short = lengths[j] <= 16
            near = np.zeros(len(i), bool)
            near[short] = _differ_once(letters, longer[j[short]], i[short], j[short])
            for k in np.flatnonzero(~short).tolist():
                near[k] = one_edit(words[i[k]].as_py(), words[j[k]].as_py())
            i, j, at = i[near], j[near], to
            # A list has words of one length in the order in which they arrived, which another list need not
            # have: a pair is told the same way round by all lists that find it.
            turned = pc.greater(words.take(pa.array(i)), words.take(pa.array(j))).to_numpy(zero_copy_only=False)
            i, j = np.where(turned, j, i), np.where(turned, i, j)
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(i)), pa.array(n[i]), words.take(pa.array(j)), pa.array(n[j])],
                names=["word", "n", "near", "near_n"])

    for batch in batches_of(batches):
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        whole_lists = int(pc.index(rows.column("key"), rows.column("key")[-1]).as_py())
        held = rows.slice(whole_lists)
        if whole_lists:
            yield from pairs(rows.slice(0, whole_lists))
    if held is not None:
        yield from pairs(held)


def near_words(words: DataFrame, frequent: int = FREQUENT, size: int = DICTIONARY, common: int = COMMON) -> DataFrame:
    """``word, near, near_n`` of all words one edit apart, both ways. ``words`` is a written table of ``word, n``
    with distinct words of ``SHORTEST`` characters or more, all of them below U+0100."""
    held, unseen = frequent_grams(words, frequent, size)
    lists = _lists(words, held, unseen, common).repartition("key").sortWithinPartitions("key", "longer")
    pairs = lists.mapInArrow(_merged, "word string, n long, near string, near_n long").distinct()
    both = F.explode(F.array(
        F.struct(F.col("word"), F.col("near"), F.col("near_n")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return pairs.select(both.alias("p")).select("p.*")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` of every row ``word, form``: forms are followed to the last, which has none.

    Every round doubles how far a word has been followed. A form comes twice as often as its word, so
    there are few rounds.
    """
    now, turn = scratch.table(forms.select("word", F.col("form").alias("root")), "roots0"), 0
    while True:
        turn += 1
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        now = scratch.table(now.join(ahead, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), f"roots{turn}")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")


def variants(docs: DataFrame, frequent: int = FREQUENT, size: int = DICTIONARY, common: int = COMMON) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words of all texts.

    A word's form is the word one edit apart that comes most often, the smallest of several, if it comes
    twice as often or more; its root is where its forms lead. A null text has no words, a null
    ``doc_id`` is an empty one. Repeated rows count again, extra columns are ignored, and an empty
    table has no words.
    """
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.table(words_of(docs), "words")
    near = near_words(words, frequent, size, common).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    best_n = -F.col("best")["less"]
    told = words.join(near, "word", "left")
    enough = best_n >= 2 * F.col("n")
    told = scratch.table(told.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best")["near"]).alias("form"), F.when(enough, best_n).alias("form_n")), "forms")
    followed = roots(told.filter("form is not null"), scratch)
    return told.join(followed, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
