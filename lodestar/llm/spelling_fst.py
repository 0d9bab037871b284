"""Spelling variant grouping (operator 11): finite-state composition.

Words are the letter runs of the texts, counted over all of them. Two words
are near if one edit (a code point inserted, deleted or replaced) turns one
into the other: the pairs that the composition of the vocabulary's acceptor,
a one-edit transducer and the acceptor again accepts.

The composition is enumerated in partitions by initial state. An edit stands
at a position p of the shorter word, where the two differ first. For an
interval [lo, hi) of p and a length of the shorter word, words that share the
``lo`` code points before it and those after it can only pair with each
other: the shared prefix is the state both acceptors start in. At first there
are two intervals a length, so a word has four rows. Where more than ``limit``
words share one, the interval is halved for them, as often as needed: at one
position at most one word per letter is left. So no group grows with the
corpus, none is cut, and each pair is found in one partition alone.

In a partition the words' trie is minimised (states are merged whose right
languages agree; each is known by a 64-bit hash of its language), and each
state has the number of words it accepts, so that a path's rank names its
word. The composition runs level by level over arrays of state pairs: before
the edit both acceptors walk alike, the edit takes two different arcs or an
arc of the longer word alone, and after it both take equal arcs.

A word's form is its near word of the largest count that is ``ratio`` times
its own; forms are followed by pointer doubling. Null texts have no words, a
null id is written as nothing. Texts are whole; very long runs are words like
others. Equal rows count each. Without words there are no rows. Only the id
and text columns are read: further columns, whatever their names, don't matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import byte_slices, frugal, lower_bytes, mix64, shuffle_partitions, text_buffers, written

#: One run in so many (by the crc32 of id and run) loses a code point. Fixed by
#: the query contract, as are the least length, count and ratio.
NOISE = 199
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
LIMIT = 4096
PART_BYTES = 8 << 20
CHUNK_ROWS = 1 << 16

#: What a register's low byte adds when it moves over a zero byte.
CRC_TABLE = np.array([zlib.crc32(bytes([b ^ 0xFF])) ^ 0xFF000000 for b in range(256)], np.uint32)
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True  # U+00C0 to U+00FF are C3 and any second byte


# ---------------------------------------------------------------- counting

def advanced(crc: np.ndarray, steps: int) -> np.ndarray:
    """crc32 registers moved over 0 to ``steps`` zero bytes (a row each): what a
    prefix adds to the crc32 of what follows it."""
    out = np.empty((steps + 1, len(crc)), np.uint32)
    out[0] = crc
    for k in range(steps):
        out[k + 1] = CRC_TABLE[out[k] & 0xFF] ^ (out[k] >> np.uint32(8))
    return out


def runs(offsets: np.ndarray, data: np.ndarray, least: int) -> tuple[np.ndarray, pa.Array]:
    """(text of each run, the runs in lower case), runs of at least ``least``
    code points."""
    lead = data == 0xC3
    inside = LETTER[data]
    inside[1:] |= lead[:-1]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    before[edge] = False
    start = np.flatnonzero(inside & ~before)
    length = np.diff(np.append(np.cumsum(inside)[start] - 1, inside.sum()))
    wide = np.concatenate([[0], np.cumsum(lead)])
    points = length - (wide[start + length] - wide[start])
    start, length = start[points >= least], length[points >= least]
    ends = np.cumsum(length)
    taken = np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
    letters = lower_bytes(data[taken])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(np.concatenate([[0], ends])), pa.py_buffer(letters)])
    return np.searchsorted(offsets, start, "right") - 1, words


def counted_part(keys: list, offsets: np.ndarray, data: np.ndarray, least: int, noise: int) -> pa.RecordBatch:
    """word, n of the runs of a part, after the noise."""
    text, words = runs(offsets, data, least)
    coded = words.dictionary_encode()
    code, known = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    size = np.fromiter(map(len, known), np.int64, len(known))
    own = np.fromiter(map(zlib.crc32, known), np.uint32, len(known))
    prefix = np.fromiter((zlib.crc32(f"{'' if k is None else k}:".encode()) for k in keys), np.uint32, len(keys))
    short = size <= 64
    table = advanced(prefix, int(size[short].max(initial=0)))
    # crc32(a + b) is crc32(a), moved over as many zero bytes as b has, xor crc32(b)
    h = table[np.where(short, size, 0)[code], text] ^ own[code]
    for i in np.flatnonzero(~short[code]):
        h[i] = zlib.crc32(known[code[i]], int(prefix[text[i]]))
    counts = np.bincount(code, minlength=len(known))
    changed: dict[bytes, int] = {}
    for i in np.flatnonzero(h.astype(np.int64) % noise == 0):
        counts[code[i]] -= 1
        word = known[code[i]].decode()
        at = int(h[i]) % len(word)
        if len(word) > least:
            new = (word[:at] + word[at + 1:]).encode()
            changed[new] = changed.get(new, 0) + 1
    left = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays([coded.dictionary.take(pa.array(left)).cast(pa.binary()),
                           pa.array(list(changed), pa.binary())]).view(pa.string()),
         pa.array(np.concatenate([counts[left], np.fromiter(changed.values(), np.int64, len(changed))]))],
        names=["word", "n"])


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_LENGTH,
                noise: int = NOISE) -> DataFrame:
    """word, n over all texts, words of at least ``least`` code points."""
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", PART_BYTES, 1 << 13):
                yield counted_part(part.column("key").to_pylist(), *text_buffers(part.column("text")), least, noise)

    return rows.mapInArrow(frugal(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------- composition

END = np.uint64(0x9E3779B97F4A7C15)
SPAN = 1 << 21  # code points and the end mark 0


class Acceptor:
    """The minimised acceptor of a matrix of words (code points, 0 after the
    end; rows in order, distinct within their ``group``). A group's initial
    state is the one that its shared first ``lo`` columns lead to; all words
    end after the last column, in one state."""

    def __init__(self, group: np.ndarray, words: np.ndarray, lo: int):
        m, width = words.shape
        new = np.append(True, group[1:] != group[:-1])  # rows that open a node of the trie
        opens = [new.copy()]
        for column in range(lo, width):
            new[1:] |= words[1:, column] != words[:-1, column]
            opens.append(new.copy())
        language = np.full(m, END)  # of the nodes of a column: a hash of their right language
        states, sizes, arcs = [language[:1]], [np.ones(1, np.int64)], []
        for column in range(width - 1, lo - 1, -1):
            above, child = opens[column - lo], np.flatnonzero(opens[column - lo + 1])
            node = np.cumsum(above)[child] - 1
            letter = words[child, column].astype(np.uint64)
            sums = np.zeros(node[-1] + 1, np.uint64)
            np.add.at(sums, node, mix64(language ^ mix64(letter + END)))
            hashed = mix64(sums)
            arcs.append((hashed[node], letter, language))
            states.append(hashed)
            sizes.append(np.diff(np.append(np.flatnonzero(above), m)))
            language = hashed
        ids, where = np.unique(np.concatenate(states), return_index=True)
        accepted = np.concatenate(sizes)[where]
        source, letter, target = (np.concatenate(x) for x in zip(*arcs, strict=True))
        self.keys, where = np.unique(np.searchsorted(ids, source) * SPAN + letter.astype(np.int64), return_index=True)
        self.letter, source = self.keys % SPAN, self.keys // SPAN
        self.target = np.searchsorted(ids, target[where])
        self.first = np.searchsorted(source, np.arange(len(ids) + 1))
        self.initial = np.searchsorted(ids, language)
        #: words accepted through the arcs before an arc of the same state: paths are ranked by their sum
        upto = np.cumsum(accepted[self.target]) - accepted[self.target]
        self.skipped = upto - upto[self.first[source]]

    def arcs_of(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``states``, arc) of every arc of the states."""
        n = self.first[states + 1] - self.first[states]
        return np.repeat(np.arange(len(states)), n), spread(self.first[states], n)

    def step(self, states: np.ndarray, letters: np.ndarray | int) -> np.ndarray:
        """The arc of each state with the letter, or -1."""
        want = states * SPAN + letters
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, at, -1)


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (n[0] numbers), first[1], ..."""
    ends = np.cumsum(n)
    return np.repeat(first - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


def near_pairs(group: np.ndarray, words: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of ``words`` (see ``Acceptor``) of one group that differ by
    one edit, first at a column of [lo, hi). Words fill the matrix but for the
    last column, or the longer ones wholly; of two that do, no pair is given."""
    fsa, final = Acceptor(group, words, lo), words.shape[1] - 1
    state, rank = fsa.initial, np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    # behind the edit: states and ranks of x and y, the letter that y must not
    # take next (-1: any), whether x has had a letter more than y
    pairs = [np.zeros(0, np.int64)] * 5 + [np.zeros(0, bool)]
    for column in range(lo, final + 1):
        x, y, rank_x, rank_y, barred, longer = pairs
        at, arc = fsa.arcs_of(x)
        same = fsa.step(y[at], fsa.letter[arc])
        good = (same >= 0) & (fsa.letter[arc] != barred[at])
        if column == final:
            good &= longer[at] | (fsa.letter[arc] == 0)
        at, arc, same = at[good], arc[good], same[good]
        found = [(fsa.target[arc], fsa.target[same], rank_x[at] + fsa.skipped[arc], rank_y[at] + fsa.skipped[same],
                  np.full(len(at), -1), longer[at])]
        at, arc = fsa.arcs_of(state)
        to, to_rank, letter = fsa.target[arc], rank[at] + fsa.skipped[arc], fsa.letter[arc]
        if column < hi:
            if column < final:  # replaced: two arcs of one state
                n = fsa.first[state[at] + 1] - arc - 1
                one = np.repeat(np.arange(len(arc)), n)
                two = spread(np.arange(len(arc)) + 1, n)
                found.append((to[one], to[two], to_rank[one], to_rank[two], np.full(len(one), -1), np.zeros(len(one), bool)))
            own = letter > 0  # inserted: x takes an arc, y stays
            found.append((to[own], state[at][own], to_rank[own], rank[at][own], letter[own], np.ones(own.sum(), bool)))
        state, rank = to, to_rank
        pairs = [np.concatenate(c) for c in zip(*found, strict=True)]
    x, y, rank_x, rank_y, barred, longer = pairs
    end = fsa.step(y, 0)  # a shorter word has its end mark left
    good = ~longer | (end >= 0)
    return rank_x[good], (rank_y + np.where(longer, fsa.skipped[end], 0))[good]


def matrix(words: list[str], width: int) -> np.ndarray:
    """Code points, a row per word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    out = np.zeros((len(words), width), np.uint32)
    out[np.repeat(np.arange(len(words)), sizes), spread(np.zeros(len(words), np.int64), sizes)] = points
    return out


def chunk_pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs of whole groups, ordered by shorter, lo, hi, gid and word."""
    shorter, lo, hi, gid = (rows.column(c).to_numpy() for c in ("shorter", "lo", "hi", "gid"))
    kind = (shorter[1:] != shorter[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    opens = np.append(True, kind | (gid[1:] != gid[:-1]))
    group = np.cumsum(opens)
    kept = np.flatnonzero(np.bincount(group)[group] > 1)
    cuts = np.flatnonzero(np.append(True, kind))
    for a, b in zip(cuts, [*cuts[1:].tolist(), len(gid)], strict=True):
        own = kept[np.searchsorted(kept, a):np.searchsorted(kept, b)]
        if not len(own):
            continue
        part = rows.take(pa.array(own))
        words = matrix(part.column("word").to_pylist(), int(shorter[a]) + 1)
        same = group[own].copy()
        before = (words[1:, :lo[a]] != words[:-1, :lo[a]]).any(axis=1)  # equal keys of different prefixes
        same[1:] += np.cumsum(before) * (group[-1] + 1)
        i, j = near_pairs(same, words, int(lo[a]), int(hi[a]))
        if len(i):
            i, j = pa.array(i), pa.array(j)
            yield pa.RecordBatch.from_arrays(
                [part.column(c).combine_chunks().take(k) for k in (i, j) for c in ("word", "n")],
                names=["a", "a_n", "b", "b_n"])


def enumerate_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a partition in order of its groups, chunk by chunk."""
    held: list[pa.RecordBatch] = []

    def whole(last: bool) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        stop = rows.num_rows
        if not last:  # the last group may go on
            tail = [rows.column(c)[-1].as_py() for c in ("shorter", "lo", "hi", "gid")]
            differs = np.zeros(stop, bool)
            for c, v in zip(("shorter", "lo", "hi", "gid"), tail, strict=True):
                differs |= rows.column(c).to_numpy() != v
            stop = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        held[:] = rows.slice(stop).to_batches()
        if stop:
            yield from chunk_pairs(rows.slice(0, stop).combine_chunks())

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK_ROWS:
            yield from whole(False)
    if held:
        yield from whole(True)


def halves(rows: DataFrame, lo: str, hi: str) -> DataFrame:
    """Rows of the two halves of each interval, with their group's key."""
    middle = F.expr(f"({lo} + {hi}) div 2").cast("int")
    span = F.explode(F.array(F.struct(F.col(lo).cast("int").alias("lo"), middle.alias("hi")),
                             F.struct(middle.alias("lo"), F.col(hi).cast("int").alias("hi"))))
    cut = rows.select("word", "n", "shorter", span.alias("span")).select("word", "n", "shorter", "span.lo", "span.hi")
    before = F.substring("word", F.lit(1), F.col("lo"))
    after = F.when(F.col("shorter") > F.col("hi"), F.right("word", F.col("shorter") - F.col("hi"))).otherwise("")
    return cut.withColumn("gid", F.xxhash64("shorter", "lo", "hi", before, after))


def near_words(vocabulary: DataFrame, least: int = MIN_LENGTH, limit: int = LIMIT) -> DataFrame:
    """``vocabulary`` (word, n; distinct words) -> a, a_n, b, b_n: each pair of
    near words once."""
    n = shuffle_partitions(vocabulary.sparkSession)
    size = F.char_length("word")
    both = F.explode(F.filter(F.array(size - 1, size), lambda x: x >= least))
    open_rows = halves(vocabulary.select("word", "n", both.alias("shorter"))
                       .select("word", "n", "shorter", F.lit(0).alias("from"), (F.col("shorter") + 1).alias("to")), "from", "to")
    ready = None
    while True:
        hot = written(open_rows.filter("hi - lo > 1").groupBy("gid").agg(F.count("*").alias("rows"))
                      .filter(F.col("rows") > limit).select("gid"), "spelling-hot")
        if hot.isEmpty():
            ready = open_rows if ready is None else ready.unionAll(open_rows)
            break
        cool = open_rows.join(hot, "gid", "left_anti").select(open_rows.columns)
        ready = cool if ready is None else ready.unionAll(cool)
        wide = open_rows.join(hot, "gid", "left_semi").select(
            "word", "n", "shorter", F.col("lo").alias("from"), F.col("hi").alias("to"))
        open_rows = halves(wide, "from", "to")
    dealt = ready.repartitionById(n, F.pmod("gid", F.lit(n)).cast("int")).sortWithinPartitions(
        "shorter", "lo", "hi", "gid", "word")
    return dealt.mapInArrow(frugal(enumerate_pairs), "a string, a_n long, b string, b_n long")


def followed(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form) without cycles -> word, root: the last form that
    a word leads to. A round doubles the steps taken."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = written(now.select("word", "root").join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, ratio: int = RATIO, noise: int = NOISE, limit: int = LIMIT) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    words = written(word_counts(docs, key, text, least, noise).filter(F.col("n") >= min_count), "spelling-words")
    pairs = written(near_words(words, least, limit), "spelling-pairs")
    sides = pairs.select(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("form")).alias("near")).unionAll(
        pairs.select(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("n"), F.col("a").alias("form")).alias("near")))
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min("near").alias("best"))
    larger = -F.col("best.n") >= F.col("n") * ratio
    known = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(larger, F.col("best.form")).alias("form"), F.when(larger, -F.col("best.n")).alias("form_n")), "spelling-forms")
    roots = followed(known.filter("form is not null").select("word", "form"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
