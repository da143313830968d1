"""Toxicity scores by a support vector machine over a gapped subsequence kernel with Nyström landmarks.

The kernel compares two units (words, or runs of single letters) by the character triples they share as subsequences; a
triple weighs DECAY to the power of the span it takes, up to SPAN characters, so gaps and inserted characters lower the
likeness but do not end it. Landmarks give a finite map (Nyström), in which a linear machine is trained on the units of
labelled sentences: a unit that toxic documents contain far more often than chance allows speaks for the sentences it
stands in, and the units of clean sentences speak against. Since the kernel is a
sum over triples, the trained machine folds into one weight per triple, which makes scoring a unit a short sum.

A document's score is a logistic function of the margins of its most toxic distinct units, so one doubtful word weighs less than
two plain insults.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shopflow.llm.base import kept_in_worker, stored
from shopflow.llm.bpe import Remembered

DECAY = 0.6
SPAN = 7
LONGEST_UNIT = 24
ALPHABET = 64
LANDMARKS = 192
SAMPLE = 4000  # documents of each class the machine is trained on
UNITS = 12_000  # clean units it is trained on
WITNESS = 15.0  # least log likelihood ratio of a unit that speaks for toxicity
TOPS = 5
TOP_NAMES = [f"top{i}" for i in range(TOPS)]
FLOOR = -1.5  # least margin, and that of a unit that a document lacks
SENTENCES = re.compile(rb"[.!?\n]+")
SPELT = re.compile(r"(?:(?<=\s)|^)(?:\S[^\S\n]+){2,}\S(?=\s|$)")
EDGES = b".,;:!?()[]{}\"'`<>"


def letter_code(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 97
    if "0" <= c <= "9":
        return 26 + ord(c) - 48
    return 36 + ord(c) % 26


def triples(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions and weights of the triples of a unit with ``length`` codes; unit norm."""
    known = kept_in_worker("string-kernel-triples", dict)  # no longer than the longest unit
    if length not in known:
        known[length] = _triples(length)
    return known[length]


def _triples(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    at = [(i, j, k) for i in range(length) for j in range(i + 1, min(i + SPAN, length)) for k in range(j + 1, min(i + SPAN, length))]
    i, j, k = np.array(at).T
    weight = DECAY ** (k - i + 1.0)
    return i, j, k, (weight / np.sqrt((weight ** 2).sum())).astype(np.float32)


def codes(unit: str) -> list[np.ndarray]:
    """Letter codes between edge marks; a unit longer than LONGEST_UNIT gives overlapping windows."""
    letters = [letter_code(c) for c in unit]
    if len(letters) > LONGEST_UNIT:
        step = LONGEST_UNIT // 2
        return [np.array([62, *letters[i:i + LONGEST_UNIT], 63]) for i in range(0, len(letters) - step, step)]
    return [np.array([62, *letters, 63])]


def triple_ids(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i, j, k, weight = triples(block.shape[1])
    return (block[:, i] * ALPHABET + block[:, j]) * ALPHABET + block[:, k], weight


def by_length(units: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of the units, their codes) in blocks of equal length."""
    blocks: dict[int, list] = {}
    for n, unit in enumerate(units):
        for part in codes(unit):
            blocks.setdefault(len(part), []).append((n, part))
    for rows in blocks.values():
        for at in range(0, len(rows), 2048):
            yield np.array([r[0] for r in rows[at:at + 2048]]), np.stack([r[1] for r in rows[at:at + 2048]])


def to_unit(word: bytes) -> str:
    return word.strip(EDGES).decode() or word.decode()


@dataclass
class Machine:
    """Weight per triple and bias; ``scale`` holds the logistic weights of the most toxic units and their bias."""

    weights: np.ndarray
    bias: float
    scale: tuple[float, ...]

    def margins(self, units: list[str]) -> np.ndarray:
        out = np.full(len(units), -np.inf)
        for numbers, block in by_length(units):
            ids, weight = triple_ids(block)
            np.maximum.at(out, numbers, self.weights[ids] @ weight + self.bias)
        return out

    def known(self) -> Remembered:
        return Remembered(lambda word: float(self.margins([to_unit(word)])[0]))

    def top_units(self, texts: list[str | None], known: Remembered) -> np.ndarray:
        """The greatest margins among the distinct units of each text, FLOOR where it has fewer; a few hundred texts at a time."""
        return np.concatenate([np.empty((0, TOPS)), *[self._tops(texts[at:at + 256], known) for at in range(0, len(texts), 256)]])

    def _tops(self, texts: list[str | None], known: Remembered) -> np.ndarray:
        lowered = [(t or "").lower() for t in texts]
        words = [set(t.encode().split()) for t in lowered]
        new = [w for w in set().union(*words) if w not in known and w not in known.old]
        known.update(zip(new, self.margins([to_unit(w) for w in new]).tolist()))
        out = np.full((len(texts), TOPS), FLOOR)
        for row, (text, own) in enumerate(zip(lowered, words)):
            own.update("".join(m.group().split()).encode() for m in SPELT.finditer(text))
            best = {}
            for w in heapq.nlargest(3 * TOPS, own, key=known.__getitem__):
                best.setdefault(to_unit(w), known[w])
            top = sorted(best.values(), reverse=True)[:TOPS]
            out[row, :len(top)] = np.maximum(top, FLOOR)
        known.renew()
        return out

    def scores(self, tops: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(tops @ np.array(self.scale[:-1]) + self.scale[-1], -60, 60)))


def kernel(units: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel values of units against landmarks; a long unit counts by its best window."""
    found = [(n, *triple_ids(block)) for n, block in by_length(landmarks)]
    used = np.unique(np.concatenate([ids.ravel() for _, ids, _ in found]))
    table = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    for numbers, ids, weight in found:
        np.add.at(table, (np.searchsorted(used, ids), numbers[:, None]), weight[None, :].repeat(len(ids), 0))
    place = np.full(ALPHABET ** 3, len(used), np.int32)
    place[used] = np.arange(len(used))
    out = np.zeros((len(units), len(landmarks)))
    for numbers, block in by_length(units):
        for at in range(0, len(numbers), 256):
            ids, weight = triple_ids(block[at:at + 256])
            np.maximum.at(out, numbers[at:at + 256], np.einsum("utl,t->ul", table[place[ids]], weight))
    return out


def newton(x: np.ndarray, y: np.ndarray, cost: np.ndarray, loss: str, ridge: float) -> np.ndarray:
    """Minimises ridge |w|^2 / 2 + sum cost * loss(y x.w); the last column of ``x`` is the bias and is not penalised."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6

    def value(w):
        m = y * (x @ w)
        return (penalty * w * w).sum() / 2 + (cost * (np.maximum(0, 1 - m) ** 2 / 2 if loss == "hinge" else np.logaddexp(0, -m))).sum()

    for _ in range(40):
        m = y * (x @ w)
        if loss == "hinge":
            slope, curve = np.where(m < 1, m - 1, 0.0) * y, (m < 1).astype(float)
        else:
            p = 1 / (1 + np.exp(np.clip(m, -60, 60)))
            slope, curve = -p * y, p * (1 - p)
        gradient = penalty * w + x.T @ (cost * slope)
        step = np.linalg.solve((x * (cost * curve)[:, None]).T @ x + np.diag(penalty + 1e-9), gradient)
        now, rate = value(w), 1.0
        while rate > 1e-4 and value(w - rate * step) > now:
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-6:
            break
    return w


def fit_units(positive: list[str], negative: list[str], weight: np.ndarray, landmarks: list[str]) -> tuple[np.ndarray, float]:
    """Weight per triple and bias of the machine trained on units; ``weight`` goes with the positive ones."""
    inner = kernel(landmarks, landmarks)
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T  # inverse square root: the Nyström map
    x = np.hstack([kernel(positive + negative, landmarks) @ root, np.ones((len(positive) + len(negative), 1))])
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    cost = np.concatenate([weight / weight.sum() * len(negative) / 2, np.ones(len(negative))])
    w = newton(x, y, cost, "hinge", 1.0)
    share = root @ w[:-1]
    table = np.zeros(ALPHABET ** 3)
    for numbers, block in by_length(landmarks):
        ids, weight_of = triple_ids(block)
        np.add.at(table, ids.ravel(), (share[numbers][:, None] * weight_of[None, :]).ravel())
    return table.astype(np.float32), float(w[-1])


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as empty text."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % modulus


def _tops(docs: DataFrame, machine: Machine, keep: list[str]) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast((machine.weights, machine.bias, machine.scale))  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Machine(*shipped.value)
        known = model.known()
        for batch in batches:
            tops = model.top_units(batch.column(batch.num_columns - 1).to_pylist(), known)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(tops[:, i]) for i in range(TOPS)], pa.array(model.scores(tops))],
                                             names=[*keep, *TOP_NAMES, "score"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:-1]] + [f"{n} double" for n in [*TOP_NAMES, "score"]])
    return docs.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE,
          units: int = UNITS, landmarks: int = LANDMARKS) -> Machine:
    """Trains on at most ``sample`` documents of each class (least key hash first); ``labels`` has one or more rows (key, label).

    A key labelled both ways counts as toxic, null keys and labels are left out. With one class only every document scores 0.
    """
    marked = labels.where(labels[key].isNotNull() & labels[label].isNotNull()).groupBy(labels[key].alias("key")).agg(F.max(labels[label]).cast("int").alias("label"))
    marked = stored(marked.withColumn("h", F.xxhash64("key")), "toxic-labels")
    chosen = stored(marked.where("label = 1").orderBy("h").limit(sample).union(marked.where("label = 0").orderBy("h").limit(sample)).select("key", "label"), "toxic-sample")
    texts = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text")).join(F.broadcast(chosen), "key")  # 2 * sample rows at most
    texts = stored(texts, "toxic-texts")

    def units_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mark, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = sorted({to_unit(w) for s in SENTENCES.split((t or "").lower().encode()) for w in s.split()})
                found = [u for u in found if len(u) <= LONGEST_UNIT]
                yield pa.RecordBatch.from_arrays([pa.array([mark] * len(found), pa.int32()), pa.array(found, pa.string())], names=["label", "unit"])

    seen = texts.select("label", "text").distinct().mapInArrow(units_of, "label int, unit string").groupBy("unit").agg(
        F.count_if(F.col("label") == 1).alias("bad"), F.count_if(F.col("label") == 0).alias("good"))
    seen = stored(seen, "toxic-units")
    counts = {r.label: r["count"] for r in texts.groupBy("label").count().collect()}
    none = Machine(np.zeros(ALPHABET ** 3, np.float32), -1.0, (0.0,) * TOPS + (-60.0,))
    if len(counts) < 2:
        return none
    # witnesses stand in toxic documents far more often than chance allows (log likelihood ratio)
    overall = counts[1] / (counts[0] + counts[1])
    part = F.col("bad") / (F.col("bad") + F.col("good"))
    surprise = 2 * (F.col("bad") * F.log(part / overall) + F.when(F.col("good") > 0, F.col("good") * F.log((1 - part) / (1 - overall))).otherwise(0.0))
    rate = (F.col("bad") / counts[1]) / ((F.col("good") + 0.25) / counts[0])
    witness = seen.where((surprise > WITNESS) & (rate > 10)).orderBy(F.desc("bad"), "unit").limit(units // 4).collect()
    if not witness:
        return none
    clean = [r.unit for r in seen.where("good > 0 and bad <= good * 2").orderBy(F.desc("good"), "unit").limit(units // 4).collect()]
    clean += [r.unit for r in seen.where("good > 0 and bad <= good * 2").orderBy(F.xxhash64("unit"), "unit").limit(units // 4).collect()]
    positive, weight = [r.unit for r in witness], np.array([float(r.bad) for r in witness])
    marks = positive[:2 * landmarks // 3] + clean[:landmarks - len(positive[:2 * landmarks // 3])]
    for last in (False, True):
        negative = sorted(set(clean) - set(positive))
        table, bias = fit_units(positive, negative, weight, marks)
        machine = Machine(table, bias, (1.0,) + (0.0,) * TOPS)
        if not last:  # the clean units that this machine gets most wrong join the training, and what is like the witnesses
            shipped = docs.sparkSession.sparkContext.broadcast((table, bias))

            def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                model = Machine(*shipped.value, (0.0,) * 4)
                for batch in batches:
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.margins(batch.column(0).to_pylist()))], names=["unit", "margin"])

            marked_units = {kind: seen.where(which).select("unit").mapInArrow(score, "unit string, margin double").orderBy(F.desc("margin"), "unit")
                            for kind, which in (("clean", "good > 0 and bad <= good * 2"), ("like", "good = 0"))}
            clean += [r.unit for r in marked_units["clean"].limit(units // 2).collect()]
            like = [r.unit for r in marked_units["like"].where("margin > 0.5").limit(units // 4).collect() if r.unit not in set(positive)]
            positive, weight = positive + like, np.concatenate([weight, np.ones(len(like))])
    rows = _tops(texts.select("label", "text"), machine, ["label"]).select("label", *TOP_NAMES).toArrow()
    x = np.column_stack([rows.column(c).to_numpy() for c in TOP_NAMES] + [np.ones(rows.num_rows)])
    y = np.where(rows.column("label").to_numpy() == 1, 1.0, -1.0)
    total = marked.groupBy("label").count().collect()
    share = {r.label: r["count"] / counts[r.label] for r in total}  # the sample holds the classes in other shares than the labels
    cost = np.array([share[1] if v > 0 else share[0] for v in y])
    machine.scale = tuple(newton(x, y, cost / cost.mean(), "logistic", 0.1))
    return machine


def score(docs: DataFrame, machine: Machine, keep: list[str], text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``keep``, score (0 to 1) and predicted (1 from ``threshold``) for every document, from its whole text alone.

    Null and empty texts score as a text without units. Repeated rows score alike; an empty table gives no row.
    """
    made = _tops(docs.select(*[docs[c].alias(c) for c in keep], docs[text].cast("string").alias("_text")), machine, keep)
    return made.select(*keep, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
