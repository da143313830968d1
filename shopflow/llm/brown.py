"""Language-model scores of a class-based bigram model (Brown et al., 1992).

The probability of a token is that of its class after the class before it times that of the word within its class. Classes
come from exchange clustering: items move one by one to the class that raises the likelihood of the class bigrams most,
until none moves. Items of this sequential part are the most frequent words and, for all other words, their endings, so its table has a
fixed size and every word, known or not, has a class by its form. The table holds the frequent endings one by one and
all others as one item. Each of those is then moved by itself, by all its neighbours, to the class that raises the same likelihood most,
the others held. With ``own`` every training word that is no item itself then makes the same move for itself, from the class of its form, by all
its neighbours, so that only words not seen in training share the class of their ending. Word counts, class sizes and transitions cover all training tokens.

Texts are cut into words once: each block of documents numbers its distinct words. What is known of a word reaches a block by a join of the block's
words, in the order of its numbers, without moving texts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from shopflow.llm.base import opened, ship, stored
from shopflow.runtime import scope

END = b""
WORDS = 640  # frequent words that are items of their own
ENDINGS = 383  # endings that clustering moves one by one; all others are one item there and get their classes after it
CLASSES = 48
DISCOUNT = 0.75
PRIOR = 20.0  # weight of the class shares against the transitions seen
BLOCK_DOCS = 10_000
BLOCK_TOKENS = 3_000_000


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lowered, then the end."""
    return [*(text or "").encode().lower().split(), END]


def ending(word: bytes) -> bytes:
    """The last two letters' bytes and what follows them: words alike in it share a class unless they are frequent."""
    core = word.rstrip(b".,;:!?\"')")
    return b"*" + core[-3:] + b"|" + word[len(core):][:1]


def numbered(end: bytes) -> int:
    """An ending as a positive number: it has three bytes and a mark at most."""
    return int.from_bytes(end, "big")


def endings_of(words: pa.Array) -> np.ndarray:
    """The :func:`ending` of each word as a number."""
    words = pa.concat_arrays([words]) if words.offset else words
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    starts, whole = ends[:-1], ends[1:]
    core = whole.copy()
    mark = np.isin(np.arange(256), list(b".,;:!?\"')"))
    left = np.flatnonzero(core > starts)
    while len(left):
        left = left[mark[data[core[left] - 1]]]
        core[left] -= 1
        left = left[core[left] > starts[left]]
    out = np.full(len(starts), ord("*"), np.int64)
    for k in (3, 2, 1):
        some = np.flatnonzero(core - starts >= k)
        out[some] = out[some] << 8 | data[core[some] - k]
    out = out << 8 | ord("|")
    some = np.flatnonzero(whole > core)
    out[some] = out[some] << 8 | data[core[some]]
    return out


@dataclass
class Classes:
    """Item of each frequent word or ending, class of each item.

    The other endings of the training texts, ``rest`` as sorted numbers, are the items after ``other``; an ending that is
    not there is ``other``. Their number is bounded by the form of an ending, not by the texts.
    """

    items: dict[bytes, int]
    other: int
    words: int = 0  # items that are words; the others are endings
    of_item: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    rest: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def bin(self, word: bytes) -> int:
        """The item of a frequent word or ending; of any other word, its ending's number below zero."""
        found = self.items.get(word)
        if found is None:
            end = ending(word)
            found = self.items.get(end)
            if found is None:
                found = -numbered(end)
        return found

    def item(self, word: bytes) -> int:
        found = self.bin(word)
        if found >= 0:
            return found
        at = int(self.rest.searchsorted(-found))
        return self.other + 1 + at if at < len(self.rest) and self.rest[at] == -found else self.other

    def bins_of(self, words: pa.Array) -> np.ndarray:
        """What :meth:`bin` gives for each word."""
        listed = sorted((numbered(e), i) for e, i in self.items.items() if i >= self.words)
        numbers, items = (np.array([x[k] for x in listed], np.int64) for k in (0, 1))
        found = endings_of(words)
        at = np.searchsorted(numbers, found)
        if len(numbers):
            at = np.minimum(at, len(numbers) - 1)
            out = np.where(numbers[at] == found, items[at], -found)
        else:
            out = -found
        known = self.listed(words)
        return np.where(known >= 0, known, out)

    def listed(self, words: pa.Array) -> np.ndarray:
        """The item of each word that is one itself, -1 for all others."""
        names = [w for w, i in self.items.items() if i < self.words]
        return pc.fill_null(pc.index_in(words, value_set=pa.array(names, pa.binary())), -1).to_numpy().astype(np.int64)

    def items_of(self, bins: np.ndarray) -> np.ndarray:
        """Items of bins as :meth:`bin` gives them."""
        if not len(self.rest):
            return np.where(bins < 0, self.other, bins)
        at = np.minimum(np.searchsorted(self.rest, -bins), len(self.rest) - 1)
        return np.where(bins >= 0, bins, np.where(self.rest[at] == -bins, self.other + 1 + at, self.other))

    def forms_of(self, words: pa.Array) -> np.ndarray:
        """Class of each word by its form."""
        return self.of_item[self.items_of(self.bins_of(words))]


class Cut:
    """Documents cut into words once, for training and for scoring.

    ``rows``: (lengths, numbers, words, kept, train, block), a row for each block of documents of which all or none are for training. ``kept``: the columns
    ``keep`` of the documents; ``lengths`` and ``numbers``: how many tokens each has, and all of them as places in ``words``,
    the distinct words of the block, of which the end is one.
    """

    def __init__(self, docs: DataFrame, keep: list[str], text: str = "text", training: Column | None = None) -> None:
        marked = docs.select(*[docs[c].alias(c) for c in keep], (F.lit(True) if training is None else F.coalesce(training, F.lit(False))).alias("_train"),
                             docs[text].cast("string").alias("_text"))
        self.fields = marked.schema.fields[:-2]
        self.rows, self._answered = blocks(marked, keep), None

    def answered(self, words: DataFrame) -> DataFrame:
        if self._answered is None or self._answered[0] is not words:
            self._answered = words, answers(self.rows, words)
        return self._answered[1]


def blocks(marked: DataFrame, keep: list[str]) -> DataFrame:
    """The rows of a :class:`Cut`; ``marked`` has the columns ``keep``, ``_train`` and ``_text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for train in (True, False):
                part = batch.filter(pc.equal(batch.column("_train"), train))
                at = 0
                texts = part.column("_text").to_pylist()
                while at < len(texts):
                    start, numbers, lengths, rows = at, defaultdict(), [], []
                    numbers.default_factory = numbers.__len__
                    size = 0
                    while at < len(texts) and at - start < BLOCK_DOCS and size < BLOCK_TOKENS:
                        listed = tokens(texts[at])
                        rows.append(np.fromiter(map(numbers.__getitem__, listed), np.uint32, len(listed)))
                        lengths.append(len(listed))
                        size += len(listed)
                        at += 1
                    made = {"lengths": pa.array([np.array(lengths, "<i4").tobytes()], pa.binary()), "numbers": pa.array([np.concatenate(rows).astype("<u4").tobytes()], pa.binary()),
                            "words": pa.array([list(numbers)], pa.list_(pa.binary())), "train": pa.array([train])}
                    if keep:
                        kept = pa.array(part.slice(start, at - start).select(list(range(len(keep)))).to_pylist())
                        made["kept"] = pa.array([kept.to_pylist()], pa.list_(kept.type))
                    yield pa.RecordBatch.from_pydict(made)

    fields = ", ".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in marked.schema.fields[:-2])
    schema = "lengths binary, numbers binary, words array<binary>, train boolean" + (f", kept array<struct<{fields}>>" if keep else "")
    return stored(marked.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()), "brown-blocks")


def sequence(lengths: bytes, numbers: bytes, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of a block, the token before each (the end before the first of a document), the first place of each document."""
    ends = np.cumsum(np.frombuffer(lengths, "<i4"))
    starts = np.concatenate([[0], ends[:-1]])
    row = np.frombuffer(numbers, "<u4")
    before = np.empty_like(row)
    before[1:] = row[:-1]
    before[starts] = end
    return row, before, starts


def count_words(made: DataFrame) -> DataFrame:
    """(word, n) over all tokens of the blocks; counted in the blocks before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column(1)[i].values
                n = np.bincount(np.frombuffer(batch.column(0)[i].as_py(), "<u4"), minlength=len(words))
                yield pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], names=["word", "n"])

    return made.select("numbers", "words").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def choose_items(counts: DataFrame, words: int, endings: int) -> Classes:
    """The most frequent words and the endings that most tokens of other words have; both lists have fixed lengths."""
    top = [bytes(r.word) for r in counts.orderBy(F.desc("n"), "word").limit(words).collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            other = pc.invert(pc.is_in(batch.column(0), value_set=pa.array(top, pa.binary())))
            listed, place = np.unique(endings_of(batch.column(0).filter(other)), return_inverse=True)
            n = np.bincount(place, batch.column(1).filter(other).to_numpy(), len(listed)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([e.to_bytes(6).lstrip(b"\0") for e in listed.tolist()], pa.binary()), pa.array(n)], names=["ending", "n"])

    ends = counts.mapInArrow(run, "ending binary, n long").groupBy("ending").agg(F.sum("n").alias("n"))
    listed = [bytes(r.ending) for r in ends.orderBy(F.desc("n"), "ending").limit(endings).collect()]
    items = {w: i for i, w in enumerate([*top, *listed])}
    return Classes(items, len(items), len(top))


def bin_bigrams(made: DataFrame, classes: Classes) -> DataFrame:
    """(left, right, n): counts of the pairs of bins over all training tokens; the end also stands before each text."""
    size = classes.other
    shipped = ship(made.sparkSession, classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = opened(shipped)
        total = np.zeros(size * size, np.int64)  # pairs of items

        def rows(left, right, n):
            for i in range(0, len(n), 100_000):
                part = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(v[part].astype(np.int64)) for v in (left, right, n)], names=["left", "right", "n"])

        for batch in batches:
            for i in range(batch.num_rows):
                lengths, numbers, words = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2)[i].values
                row, before, _ = sequence(lengths, numbers, words.index(END).as_py())
                bins, place = np.unique(of.bins_of(words), return_inverse=True)
                right, left = place[row], place[before]
                items = (bins[left] >= 0) & (bins[right] >= 0)
                np.add(total, np.bincount(bins[left[items]] * size + bins[right[items]], minlength=size * size), out=total)
                pair, n = np.unique(left[~items] * len(bins) + right[~items], return_counts=True)
                yield from rows(bins[pair // len(bins)], bins[pair % len(bins)], n)
        at = np.flatnonzero(total)
        yield from rows(at // max(size, 1), at % max(size, 1), total[at])

    return made.select("lengths", "numbers", "words").mapInArrow(run, "left long, right long, n long").groupBy("left", "right").agg(F.sum("n").alias("n"))


def item_bigrams(bigrams: DataFrame, classes: Classes) -> np.ndarray:
    """Counts of the pairs of items, all other endings as one item. Its size is items squared."""
    size = classes.other + 1
    left, right = (F.when(F.col(c) < 0, classes.other).otherwise(F.col(c)) for c in ("left", "right"))
    rows = bigrams.groupBy((left * size + right).cast("long").alias("pair")).agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size, np.int64)
    out[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(size, size)


def class_bigrams(bigrams: DataFrame, found: Classes, classes: int) -> np.ndarray:
    """Counts of the pairs of classes over all training tokens."""
    shipped = ship(bigrams.sparkSession, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = opened(shipped)
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            left, right = (of.of_item[of.items_of(batch.column(k).to_numpy())] for k in (0, 1))
            np.add.at(total, left * classes + right, batch.column(2).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes * classes)), pa.array(total)], names=["pair", "n"])

    out = np.zeros(classes * classes, np.int64)
    for r in bigrams.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r.pair] = r.n
    return out.reshape(classes, classes)


def _xlogx(v: np.ndarray) -> np.ndarray:
    return v * np.log(np.maximum(v, 1e-300))


def _best_class(table: np.ndarray, r: np.ndarray, l: np.ndarray, own: float, here: int) -> int:
    """The class that an item taken out of ``table`` raises the likelihood in most; ``here`` if none is better.

    ``r``, ``l`` and ``own``: how often classes follow the item, stand before it, and the item itself follows.
    """
    every = np.arange(len(table))
    rows, columns = table.sum(1) + l, table.sum(0) + r  # the item counts as a neighbour wherever it goes
    rsum, lsum = r.sum() + own, l.sum() + own
    # joining class c adds r to its row, l to its column and own to its corner
    gain = (_xlogx(table + r[None, :]) - _xlogx(table)).sum(1) + (_xlogx(table.T + l[None, :]) - _xlogx(table.T)).sum(1)
    corner = table[every, every]
    gain += _xlogx(corner + r + l + own) - _xlogx(corner + r) - _xlogx(corner + l) + _xlogx(corner)
    gain -= _xlogx(rows + rsum) - _xlogx(rows) + _xlogx(columns + lsum) - _xlogx(columns)
    best = int(np.argmax(gain))
    return here if gain[best] <= gain[here] + 1e-9 else best


def exchange(bigrams: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Class of each item. Starts with the items dealt out by frequency and moves each to its best class in turn, until none moves.

    Each move raises the likelihood, so this ends.
    """
    n = len(bigrams)
    order = np.argsort(-bigrams.sum(0), kind="stable")
    of = np.empty(n, np.int64)
    of[order] = np.arange(n) % classes
    counts = bigrams.astype(np.float64)
    member = np.zeros((n, classes))
    member[np.arange(n), of] = 1
    table = member.T @ counts @ member
    into, outof = counts @ member, counts.T @ member  # item to next class, item to class before
    moved = 1
    while moved:
        moved = 0
        for i in order:
            r, l, own, here = into[i].copy(), outof[i].copy(), counts[i, i], of[i]
            if not r.any() and not l.any():
                continue
            r[here] -= own
            l[here] -= own
            # take the item out
            table[here, :] -= r
            table[:, here] -= l
            table[here, here] -= own
            best = _best_class(table, r, l, own, here)
            table[best, :] += r
            table[:, best] += l
            table[best, best] += own
            if best != here:
                moved += 1
                of[i] = best
                into[:, here] -= counts[:, i]
                into[:, best] += counts[:, i]
                outof[:, here] -= counts[i, :]
                outof[:, best] += counts[i, :]
    return of


def place_rest(bigrams: DataFrame, found: Classes, table: np.ndarray) -> Classes:
    """``found`` with a class for every other ending: the best by all its neighbours, as in :func:`exchange`, the others held.

    ``table``: counts of the pairs of classes while all these endings are one item.
    """
    classes, here = len(table), int(found.of_item[found.other])
    shipped = ship(bigrams.sparkSession, (found, table.astype(np.float64)))

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, _ = opened(shipped)
        for batch in batches:
            left, right, n = (batch.column(k).to_numpy() for k in range(3))
            before, after = (of.of_item[of.items_of(v)] for v in (left, right))
            first, second, twice = left < 0, right < 0, (left < 0) & (left == right)
            yield pa.RecordBatch.from_arrays(
                [pa.array(-np.concatenate([left[first], right[second], left[twice]])),
                 pa.array(np.concatenate([after[first], classes + before[second], np.full(twice.sum(), 2 * classes)]), pa.int64()),
                 pa.array(np.concatenate([n[first], n[second], n[twice]]))], names=["ending", "at", "n"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, held = opened(shipped)
        for batch in batches:
            chosen = []
            for near in batch.column(1).to_pylist():
                seen = np.zeros(2 * classes + 1)
                for at in near:
                    seen[at["at"]] = at["n"]
                r, l, own = seen[:classes], seen[classes:-1], seen[-1]
                r[here] -= own
                l[here] -= own
                rest = held.copy()
                rest[here, :] -= r
                rest[:, here] -= l
                rest[here, here] -= own
                chosen.append(_best_class(rest, r, l, own, here))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chosen, pa.int64())], names=["ending", "c"])

    near = (bigrams.where("left < 0 or right < 0").mapInArrow(sides, "ending long, at long, n long").groupBy("ending", "at").agg(F.sum("n").alias("n"))
            .groupBy("ending").agg(F.collect_list(F.struct("at", "n")).alias("near")))
    rows = near.mapInArrow(best, "ending long, c long").toArrow()
    numbers, chosen = rows.column("ending").to_numpy(), rows.column("c").to_numpy()
    order = np.argsort(numbers)
    return replace(found, of_item=np.concatenate([found.of_item, chosen[order]]), rest=numbers[order])


def neighbours(made: DataFrame, found: Classes, classes: int) -> DataFrame:
    """(word, here, near): for each word of a block its class by form and how often classes, by form, stand at it.

    ``near`` has a long for each place, the place in its upper and the count in its lower 32 bits: classes after the word, then
    those before it, then the word after itself.
    """
    shipped = ship(made.sparkSession, found)
    width = 2 * classes + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = opened(shipped)
        for batch in batches:
            for i in range(batch.num_rows):
                lengths, numbers, words = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2)[i].values
                row, before, _ = sequence(lengths, numbers, words.index(END).as_py())
                row, before = row.astype(np.int64), before.astype(np.int64)
                kinds = of.forms_of(words)
                twice = row[row == before]
                places = np.concatenate([before * width + kinds[row], row * width + classes + kinds[before], twice * width + 2 * classes])
                places, n = np.unique(places, return_counts=True)
                begins = np.searchsorted(places, np.arange(len(words) + 1) * width)
                packed = ((places % width) << 32 | n).astype("<i8").view(np.uint8)
                offsets = pa.py_buffer((begins * 8).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [words, pa.array(kinds, pa.int32()), pa.Array.from_buffers(pa.binary(), len(words), [None, offsets, pa.py_buffer(packed)])],
                    names=["word", "here", "near"])

    return made.select("lengths", "numbers", "words").mapInArrow(run, "word binary, here int, near binary")


def best_classes(table: np.ndarray, r: np.ndarray, l: np.ndarray, own: np.ndarray, here: np.ndarray) -> np.ndarray:
    """What :func:`_best_class` gives for each of many items, each taken out of ``table`` by itself and the others held.

    ``r``, ``l`` (a row for each item) and ``own`` as there, before the item is taken out, with itself as a neighbour in its class ``here``.
    Only places that hold something cost more than a look.
    """
    each = np.arange(len(here))
    r, l = r.copy(), l.copy()
    r[each, here] -= own
    l[each, here] -= own
    gain = np.zeros_like(r)
    for near, across, kept in ((r, l, table), (l, r, table.T)):  # kept[c, j]: class c with its neighbour j on this side
        item, j = np.nonzero(near)
        one = _xlogx(kept.T + 1) - _xlogx(kept.T)
        n, at = near[item, j], here[item]
        for some in np.array_split(np.arange(len(item)), max(1, len(item) // 50_000)):
            more = one[j[some]]  # (place, class), as if the count were 1 and the item not in the class of its place
            here_at = kept[at[some], j[some]] - n[some]
            more[np.arange(len(some)), at[some]] = _xlogx(here_at + n[some]) - _xlogx(here_at)
            inside = j[some] == at[some]
            full = np.flatnonzero((n[some] != 1) | inside)
            held, inside, who = kept.T[j[some[full]]], inside[full], some[full]
            held[inside] -= across[item[who[inside]]]
            held[np.arange(len(full)), at[who]] -= n[who] + np.where(inside, own[item[who]], 0)
            more[full] = _xlogx(held + n[who][:, None]) - _xlogx(held)
            first = np.flatnonzero(np.concatenate([[True], item[some][1:] != item[some][:-1]])) if len(some) else some
            if len(some):
                gain[item[some][first]] += np.add.reduceat(more, first, axis=0)
    rsum, lsum = r.sum(1) + own, l.sum(1) + own
    corner = np.repeat(np.diag(table)[None, :], len(here), 0)
    corner[each, here] -= r[each, here] + l[each, here] + own
    gain += _xlogx(corner + r + l + own[:, None]) - _xlogx(corner + r) - _xlogx(corner + l) + _xlogx(corner)
    for sums, n in ((table.sum(1), rsum), (table.sum(0), lsum)):
        held = np.repeat(sums[None, :], len(here), 0)
        held[each, here] -= n
        gain -= _xlogx(held + n[:, None]) - _xlogx(held)
    best = gain.argmax(1)
    return np.where(gain[each, best] <= gain[each, here] + 1e-9, here, best)


def place_words(made: DataFrame, found: Classes, table: np.ndarray) -> DataFrame:
    """(word, n, c): every training word with its count and class: its own item's, or the best by all its neighbours.

    A word that is no item is taken out of the class of its form, as :func:`place_rest` does with an ending, the others held.
    ``table``: counts of the pairs of classes by form.
    """
    classes, width = len(table), 2 * len(table) + 1
    shipped = ship(made.sparkSession, (found, table.astype(np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = opened(shipped)

        def placed(rows: pa.RecordBatch) -> pa.RecordBatch:
            words, near = rows.column(0), rows.column(2)
            new = np.concatenate([[True], pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)])
            first, group = np.flatnonzero(new), np.cumsum(new) - 1
            offsets = np.frombuffer(near.buffers()[1], np.int32)[near.offset:near.offset + len(near) + 1]
            packed = np.frombuffer(near.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view("<i8")
            seen = np.bincount(np.repeat(group, np.diff(offsets) // 8) * width + (packed >> 32), packed & 0xFFFFFFFF, len(first) * width).reshape(-1, width)
            here = rows.column(1).to_numpy()[first].astype(np.int64)
            n = seen[:, classes:-1].sum(1).astype(np.int64)  # every occurrence has one token before it
            names = words.take(pa.array(first))
            free = np.flatnonzero(of.listed(names) < 0)
            here[free] = best_classes(held, seen[free, :classes], seen[free, classes:-1], seen[free, -1], here[free])
            return pa.RecordBatch.from_arrays([names, pa.array(n), pa.array(here, pa.int32())], names=["word", "n", "c"])

        left = None
        for batch in batches:
            if left is not None:
                batch = pa.concat_batches([left, batch])
            last, cut = batch.column(0)[batch.num_rows - 1], batch.num_rows - 1
            while cut and batch.column(0)[cut - 1] == last:
                cut -= 1
            if cut:
                yield placed(batch.slice(0, cut))
            left = batch.slice(cut)  # the last word may go on
        if left is not None and left.num_rows:
            yield placed(left)

    parts = int(made.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = neighbours(made, found, classes).repartition(parts, "word").sortWithinPartitions("word")
    return stored(near.mapInArrow(run, "word binary, n long, c int"), "brown-words", keep=True)


def by_form(counts: DataFrame, found: Classes) -> DataFrame:
    """(word, n, c): every training word with its count and the class of its form."""
    shipped = ship(counts.sparkSession, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = opened(shipped)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of.forms_of(batch.column(0)), pa.int32())], names=["word", "n", "c"])

    return stored(counts.select("word", "n").mapInArrow(run, "word binary, n long, c int"), "brown-words", keep=True)


def answers(made: DataFrame, words: DataFrame) -> DataFrame:
    """(block, at, n, c, new): for each block the places of its words, their counts and classes by ``words``; -1 for the class of the words
    that are not there, which ``new`` has in the same order."""
    asked = made.select("block", F.posexplode("words").alias("at", "word"))
    found = asked.join(words, "word", "left").select("block", "at", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("c", F.lit(-1)).alias("c"), F.when(F.col("n").isNull(), F.col("word")).alias("new"))
    return stored(found.groupBy("block").agg(*[F.collect_list(c).alias(c) for c in ("at", "n", "c", "new")]), "brown-answers")


def with_end(made: DataFrame) -> DataFrame:
    """The blocks with the place of the end in place of their words."""
    return made.withColumn("end", F.array_position("words", F.lit(bytearray(END))).cast("int") - 1).drop("words")


def word_bigrams(made: DataFrame, answered: DataFrame, classes: int) -> np.ndarray:
    """Counts of the pairs of classes over all tokens of the blocks, each word in its class of ``answered``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                lengths, numbers, end, at, c = (batch.column(k)[i] for k in range(5))
                kinds = np.zeros(len(at.values), np.int64)
                kinds[at.values.to_numpy()] = c.values.to_numpy()
                row, before, _ = sequence(lengths.as_py(), numbers.as_py(), end.as_py())
                total += np.bincount(kinds[before] * classes + kinds[row], minlength=classes * classes)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes * classes)), pa.array(total)], names=["pair", "n"])

    known = with_end(made).join(answered, "block").select("lengths", "numbers", "end", "at", "c")
    out = np.zeros(classes * classes, np.int64)
    for r in known.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r.pair] = r.n
    return out.reshape(classes, classes)


@dataclass
class Model:
    """``tokens`` and ``kinds``: all and distinct training tokens; ``after``: log10 probability of a class after a class;
    ``size`` and ``distinct``: tokens and distinct words of each class; ``unseen``: estimated number of its unknown words, if
    they are to share what is taken off the known ones."""

    classes: Classes
    tokens: int
    kinds: int
    after: np.ndarray
    size: np.ndarray
    distinct: np.ndarray
    unseen: np.ndarray | None = None

    def emission(self, counts: np.ndarray, of: np.ndarray) -> np.ndarray:
        """log10 probability of words with ``counts`` in classes ``of``: discounted; what is taken off goes to unknown words.

        With ``unseen`` each of them has its share, otherwise each has the whole.
        """
        size, distinct = np.maximum(self.size[of], 1.0), np.maximum(self.distinct[of], 1.0)
        unknown = np.where(self.size[of] > 0, DISCOUNT * distinct / size, 1.0)
        if self.unseen is not None:
            unknown = unknown / self.unseen[of]
        return np.log10(np.where(counts > 0, (counts - DISCOUNT) / size, unknown))


def unseen_kinds(distinct: np.ndarray, once: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """Estimated unknown words of each class: by those seen once and twice (Chao, 1984), and at least so many that an unknown
    word is no more probable than one seen once. A class without words takes the estimate of all."""
    def estimate(distinct, once, twice):
        return np.maximum(once * (once - 1) / (2 * (twice + 1)), np.maximum(DISCOUNT / (1 - DISCOUNT) * distinct, 1.0))

    return np.where(distinct > 0, estimate(distinct, once, twice), estimate(distinct.sum(), once.sum(), twice.sum()))


def train(texts: DataFrame, words: int = WORDS, endings: int = ENDINGS, classes: int = CLASSES, divide: bool = False, own: bool = False,
          cut: Cut | None = None) -> tuple[Model, DataFrame]:
    """The model of all texts (one column ``text``) and its words as a table (word, n, c): counts and classes.

    ``divide``: the unknown words of a class share its discounted mass instead of having it each. ``own``: every word has the class that its own
    neighbours give it; otherwise words that are no item have the class of their ending. ``cut`` has the texts cut into words, where that is done already.
    """
    cut = cut or Cut(texts, [])
    made = cut.rows.where("train")
    with scope(texts.sparkSession):
        counts = stored(count_words(made), "brown-counts")
        totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        found = choose_items(counts, words, endings)
        with scope(texts.sparkSession):
            bigrams = stored(bin_bigrams(made, found), "brown-bigrams")
            found.of_item = exchange(item_bigrams(bigrams, found), classes)
            found = place_rest(bigrams, found, class_bigrams(bigrams, found, classes))
            pairs = class_bigrams(bigrams, found, classes)
        known = place_words(made, found, pairs) if own else by_form(counts, found)
    if own:
        pairs = word_bigrams(made, cut.answered(known), classes)
    share = (pairs.sum(0) + 1) / (pairs.sum() + classes)
    after = np.log10((pairs + PRIOR * share[None, :]) / (pairs.sum(1, keepdims=True) + PRIOR))
    rows = known.groupBy("c").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect()
    size, distinct, once, twice = np.zeros((4, classes))
    for r in rows:
        size[r.c], distinct[r.c], once[r.c], twice[r.c] = r.n, r.kinds, r.once, r.twice
    return Model(found, totals[0], totals[1], after, size, distinct, unseen_kinds(distinct, once, twice) if divide else None), known


def score(docs: DataFrame, model: Model, words: DataFrame, keep: list[str], text: str = "text", cut: Cut | None = None) -> DataFrame:
    """``keep``, n_tokens, n_known, base_score and score (log10 probabilities) of every document's whole text.

    ``words``: counts and classes as :func:`train` gives them; a word that is not there has the class of its form. ``cut`` has the documents cut into
    words with ``keep``, where that is done already. Null and empty texts are one token,
    the end. Without training tokens every known probability is that of an unknown word. Repeated rows score alike; an empty table gives no row.
    """
    cut = cut or Cut(docs, keep, text)
    shipped = ship(docs.sparkSession, model)  # bounded by the endings' form

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = opened(shipped)
        for batch in batches:
            for i in range(batch.num_rows):
                kept, lengths, numbers, end, at, n, c, new = (batch.column(j)[i] for j in range(8))
                at, n, c = (v.values.to_numpy() for v in (at, n, c))
                of, count = np.empty(len(at), np.int64), np.empty(len(at))
                count[at], of[at] = n, c
                of[at[c < 0]] = m.classes.forms_of(new.values)
                row, before, starts = sequence(lengths.as_py(), numbers.as_py(), end.as_py())
                base = np.log10((count + 1) / (m.tokens + m.kinds + 1))
                summed = [np.add.reduceat(v[row], starts) for v in (base, m.emission(count, of), (count > 0).astype(np.int64))]
                moves = np.add.reduceat(m.after[of[before], of[row]], starts)
                columns = [kept.values.field(k) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.diff(np.append(starts, len(row))), pa.int64()), pa.array(summed[2]), pa.array(summed[0]), pa.array(summed[1] + moves)],
                    names=[*keep, "n_tokens", "n_known", "base_score", "score"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in cut.fields] + ["n_tokens long", "n_known long", "base_score double", "score double"])
    rows = with_end(cut.rows).join(cut.answered(words), "block")
    return rows.select("kept", "lengths", "numbers", "end", "at", "n", "c", "new").mapInArrow(sums, schema)


def perplexity(log10_score: Column, n_tokens: Column) -> Column:
    """Perplexity per token of a log10 probability."""
    return F.pow(F.lit(10.0), -log10_score / n_tokens)
