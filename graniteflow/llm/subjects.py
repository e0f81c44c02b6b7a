"""Problem 8: the subjects of each document, from none to several.

Method: one linear classifier for each subject against the rest, over hashed n-grams of words (pairs of characters in
scripts without spaces), trained on weak labels. A label names the subject of a passage, yet only some of its
sentences are about it and some labels are wrong; so only n-grams whose use is shown to lean to one subject are
columns, and a sentence keeps the label it inherits only where one of them bears it out. Labelled passages come from
the example table and, for words that it lacks, from a bounded sample of documents. These get weak labels from what stands
beside their sentences: the parts of their address (source and document type) and the titles of their sections. A value labels
a document if it names a subject, or if the documents that have it lean to one subject by what the model so far finds in them
(lower 95 % bound of the share). Where no value speaks, a document is labelled by the subject that the model finds in it and in
no small part another, or by none where its sentences do not look open either. The threshold of every subject is calibrated
on held-out passages.

A document has a subject when at least ``SHARE`` of its sentences are about it; headings and tables do not count.

Bounds: at most ``EXAMPLES`` labelled passages and ``SAMPLE`` documents are used for fitting, which one task does; the model is
a table of the n-grams with a weight that matters, at most ``2**HASH_BITS`` rows, written once for the same examples and
sample and read by later queries of the session. Everything else runs over all documents, in one pass without a shuffle.

Defined results: null, empty and blank texts and texts of headings and tables only have no subject, so no row; a
document has a subject at most once; repeated rows are each classified; a null label counts as no label.
"""

from __future__ import annotations

import html
import itertools
import pickle
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graniteflow.session import ensure_checkpoint_dir

HASH_BITS, EXAMPLES, SAMPLE, SHARE, SEED = 20, 20_000, 3000, 0.25, 4
ROUNDS, PENALTY, POSITIVE = 60, 2e-6, 6.0
PURE_FEW, PURE, NEUTRAL, LABELLED, FRAME = 0.4, 0.5, 0.1, 0.2, 20
LEAN, LEAN_FEW = 0.5, 5
MARKUP = re.compile(r"<[^<>\n]{1,80}>")
TABLE = re.compile(r"<table\b.*?</table>", re.S | re.I)
END = re.compile(r"(?<=[。！？])|(?<=[.!?])[\"')\]]*\s+(?=[\"'(\[]*[^\W\d_a-z]|\d)", re.M)
SHORT = re.compile(r"(?:\b(?:co|ltd|inc|corp|plc|no|nos|cf|approx|mr|mrs|ms|dr|st|vs|etc|bzw|ca|nr)|\b\w\.\w|\b[a-z])\.$", re.I)
TOKEN = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
WIDE = re.compile(r"[㐀-鿿豈-﫿぀-ヿ]+")


def sentences(text: str | None) -> list[str]:
    """The sentences of a text without headings, tables and markup."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(html.unescape(text))
    if "<" in text:
        text = MARKUP.sub(" ", TABLE.sub("\n", text))
    out = []
    for line in text.split("\n"):
        line = line.strip()
        if not line or line[0] == "#" or line[0] == "|":
            continue
        held = ""
        for part in END.split(line):
            held = f"{held} {part}" if held else part
            if held.endswith(".") and SHORT.search(held[-8:]):
                continue
            if TOKEN.search(held):
                out.append(held)
            held = ""
        if held and TOKEN.search(held):
            out.append(held)
    return out


def grams(sentence: str) -> list[str]:
    """Words and pairs of words in lower case; pairs of characters where words are not spaced."""
    if not sentence.isascii():
        sentence = unicodedata.normalize("NFKC", sentence).replace("\u200b", "").replace("\xad", "")
    out, before = [], ""
    for w in TOKEN.findall(sentence.lower()):
        if not w.isascii() and WIDE.match(w):
            out += [w[i : i + 2] for i in range(len(w) - 1)] or [w]
            before = ""
            continue
        out.append(w)
        if before:
            out.append(f"{before} {w}")
        before = w
    return out


def slot(gram: str) -> int:
    """The place of an n-gram in the hashed space."""
    return zlib.crc32(gram.encode("utf-8", "replace")) & ((1 << HASH_BITS) - 1)


class Design:
    """Which columns (n-grams in at least ``least`` sentences) every sentence has, by sentence and by column."""

    def __init__(self, sents: list[list[int]], least: int = 2):
        sizes = [len(x) for x in sents]
        flat = np.fromiter(itertools.chain.from_iterable(sents), np.int64, sum(sizes))
        row = np.repeat(np.arange(len(sents)), sizes)
        slots, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
        fit_for = counts >= least
        self.used, rank = slots[fit_for], np.cumsum(fit_for) - 1
        keep = fit_for[place]
        bias = np.arange(len(sents))  # one more column, which every sentence has
        self.set_pairs(np.r_[row[keep], bias], np.r_[rank[place[keep]], np.full(len(bias), len(self.used))], len(sents))

    def set_pairs(self, row: np.ndarray, column: np.ndarray, rows: int) -> None:
        self.rows, self.columns = rows, len(self.used) + 1
        order = np.lexsort((column, row))
        self.row, self.column = row[order], column[order]
        self.starts = np.searchsorted(self.row, np.arange(rows))
        self.by_column = np.argsort(self.column, kind="stable")
        self.have, self.column_starts = np.unique(self.column[self.by_column], return_index=True)

    def part(self, keep: np.ndarray) -> Design:
        """The sentences of which ``keep`` is true, with the same columns."""
        new = object.__new__(Design)
        new.used, rank, held = self.used, np.cumsum(keep) - 1, keep[self.row]
        new.set_pairs(rank[self.row[held]], self.column[held], int(keep.sum()))
        return new

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(w[self.column], self.starts, axis=0)

    def gradient(self, error: np.ndarray) -> np.ndarray:
        out = np.zeros((self.columns, error.shape[1]), np.float32)
        out[self.have] = np.add.reduceat(error[self.row[self.by_column]], self.column_starts, axis=0)
        return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: Design, y: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY, weight: float = POSITIVE) -> np.ndarray:
    """Weights (columns x subjects) of independent logistic models, by Adam on the whole batch."""
    w = np.zeros((x.columns, y.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    w[-1] = -2
    heavy = (1 + (weight - 1) * y).astype(np.float32)
    for t in range(1, rounds + 1):
        error = (logistic(x.scores(w)) - y) * heavy
        g = x.gradient(error) / x.rows + penalty * w
        g[-1] -= penalty * w[-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def telling(x: Design, label: np.ndarray, unit: np.ndarray, subjects: int, pure: float) -> np.ndarray:
    """The subject that each column speaks for, or -1.

    A column is counted once in every unit (a passage, or a sentence where texts have copies). It speaks for its most
    frequent subject if the lower bound of that subject's share, at one-sided 95 %, is at least ``pure``; so words of
    all subjects, and names that were met once, speak for none.
    """
    seen = np.unique(np.stack([x.column, unit[x.row]]), axis=1)
    of = np.zeros(unit.max(initial=0) + 1, np.int64)
    of[unit] = label
    count = np.zeros((x.columns, subjects + 1))  # the last one for units without a subject
    np.add.at(count, (seen[0], of[seen[1]]), 1)
    n, z = count.sum(axis=1), 1.645
    count = count[:, :-1]
    top = count.max(axis=1)
    share = top / np.maximum(n, 1)
    low = (share + z * z / (2 * n.clip(1)) - z * np.sqrt(share * (1 - share) / n.clip(1) + z * z / (4 * n.clip(1) ** 2))) / (1 + z * z / n.clip(1))
    return np.where(low >= pure, count.argmax(axis=1), -1)


def refined(x: Design, label: np.ndarray, unit: np.ndarray, subjects: int, pure: float = PURE_FEW) -> tuple[np.ndarray, Design]:
    """(weights, design) over the telling columns; ``label`` and ``unit`` belong to the sentences.

    A sentence keeps the label it inherited where a telling column bears it out and is neutral otherwise. The label ``subjects`` is that of texts without a subject.
    """
    speaks = telling(x, label, unit, subjects, pure)
    speaks[-1] = -1
    kept = np.flatnonzero(speaks >= 0)
    new = object.__new__(Design)
    new.used, rank = x.used[kept], np.full(x.columns, -1)
    rank[kept] = np.arange(len(kept))
    held, each = rank[x.column] >= 0, np.arange(x.rows)
    new.set_pairs(np.r_[x.row[held], each], np.r_[rank[x.column[held]], np.full(x.rows, len(kept))], x.rows)
    votes = np.zeros((x.rows, subjects), np.float32)
    np.add.at(votes, (x.row[held], speaks[x.column[held]]), 1)
    borne = (label < subjects) & (votes[each, np.minimum(label, subjects - 1)] > 0)
    target = np.zeros_like(votes)
    target[each[borne], label[borne]] = 1
    return fit(new, target), new


def shares(p: np.ndarray, owner: np.ndarray, passages: int, at: np.ndarray) -> np.ndarray:
    """Share of the sentences of each passage that are about each subject."""
    hit = np.zeros((passages, p.shape[1]))
    np.add.at(hit, owner, p >= at)
    return hit / np.maximum(1, np.bincount(owner, minlength=passages))[:, None]


class Model:
    """Weights by n-gram and the threshold of every subject."""

    def __init__(self, subjects: list[str], used: np.ndarray, w: np.ndarray, at: np.ndarray):
        self.subjects, self.bias = subjects, w[-1]
        self.cut = np.log(at / (1 - at)).astype(np.float32)
        matters = np.abs(w[:-1]).max(axis=1) > 0.05
        self.rows = {int(s): i for i, s in enumerate(used[matters])}
        self.weights = np.vstack([w[:-1][matters], np.zeros((1, len(subjects)), np.float32)])
        self.memory: dict[str, int] = {}
        self.values, self.speaks = 0, {}  # values of metadata that were looked at, and those that speak for a subject

    def place(self, gram: str) -> int:
        """The row of weights of an n-gram; the last row, of zeros, for those that do not matter."""
        row = self.rows.get(slot(gram), len(self.rows))
        if len(self.memory) > 500_000:
            self.memory.clear()
        self.memory[gram] = row
        return row

    def scores_of(self, slots: list[list[int]]) -> np.ndarray:
        """Score above the threshold of sentences given by the slots of their n-grams."""
        none, get = len(self.rows), self.rows.get
        flat = [[none, *(r for s in own if (r := get(s)) is not None)] for own in slots]
        starts = np.r_[0, np.cumsum([len(x) for x in flat[:-1]])].astype(np.int64)
        return np.add.reduceat(self.weights[np.array(list(itertools.chain.from_iterable(flat)))], starts, axis=0) + self.bias - self.cut

    def scores(self, sents: list[str]) -> np.ndarray:
        """Score above the threshold (sentences x subjects)."""
        none, get, place = len(self.rows), self.memory.get, self.place
        flat, sizes = [], []
        for s in sents:
            own = {r for g in grams(s) if (r := (k if (k := get(g)) is not None else place(g))) != none}
            own.add(none)
            flat.extend(own)
            sizes.append(len(own))
        starts = np.r_[0, np.cumsum(sizes[:-1])].astype(np.int64)
        return np.add.reduceat(self.weights[np.array(flat)], starts, axis=0) + self.bias - self.cut

    def classify(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, subject number) of all subjects with a large enough share of a text's sentences."""
        lists = [sentences(t) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in lists])
        if not len(owner):
            return owner, owner
        share = shares(self.scores([s for x in lists for s in x]), owner, len(texts), np.zeros(len(self.subjects)))
        return np.nonzero(share >= SHARE)


def prepare(texts: list[str]) -> tuple[list[list[int]], np.ndarray]:
    """(slots of each sentence, the passage it belongs to)."""
    lists = [[list({slot(g) for g in grams(s)}) for s in sentences(t)] for t in texts]
    return [s for x in lists for s in x], np.repeat(np.arange(len(texts)), [len(x) for x in lists])


def thresholds(x: Design, owner: np.ndarray, label: np.ndarray, subjects: int, folds: int = 3) -> np.ndarray:
    """For every subject the threshold that separates held-out passages best (F1), the middle one of equals."""
    p = np.zeros((x.rows, subjects), np.float32)
    fold = (np.arange(len(label)) % folds)[owner]
    for f in range(folds):
        if (inside := fold != f).any() and not inside.all():
            w, small = refined(x.part(inside), label[owner[inside]], owner[inside], subjects)
            full = np.zeros((x.columns, subjects), np.float32)
            full[np.r_[np.searchsorted(x.used, small.used), x.columns - 1]] = w
            p[~inside] = logistic(x.part(~inside).scores(full))
    grid, truth = np.arange(0.3, 0.71, 0.05), np.arange(subjects) == label[:, None]
    f1 = []
    for t in grid:
        said = shares(p, owner, len(label), np.full(subjects, t)) >= SHARE
        f1.append(2 * (said & truth).sum(axis=0) / np.maximum(1, said.sum(axis=0) + truth.sum(axis=0)))
    f1 = np.array(f1)
    return np.array([np.median(grid[np.isclose(f1[:, k], f1[:, k].max())]) for k in range(subjects)])


def metadata(text: str | None, source: str | None, kind: str | None) -> list[str]:
    """What stands beside a document's sentences: the parts of its address and the titles of its sections."""
    out = [f"{name} {v.strip().lower()}" for name, v in (("source", source), ("type", kind)) if v and v.strip()]
    titles = {" ".join(TOKEN.findall(line.lower())) for line in (text or "").split("\n") if line.startswith("#")}
    return out + [f"section {t}" for t in sorted(titles) if t]


def leaning(values: list[list[str]], named: np.ndarray, subjects: list[str]) -> dict[str, int]:
    """The subject that each value of metadata speaks for: one that a title names, or one that most documents with it have."""
    seen: dict[str, Counter] = defaultdict(Counter)
    for own, label in zip(values, named):
        for v in set(own) if label >= 0 else ():
            seen[v][int(label)] += 1
    out, z = {}, 1.645
    for v, count in seen.items():
        label, top = count.most_common(1)[0]
        n = sum(count.values())
        share = top / n
        low = (share + z * z / (2 * n) - z * np.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        if n >= LEAN_FEW and label < len(subjects) and low >= LEAN:
            out[v] = label
    for v in {v for own in values for v in own if v.startswith("section ")}:
        words = set(v.split()[1:])
        for k, s in enumerate(subjects):
            if set(s.lower().replace("_", " ").split()) <= words:
                out[v] = k
    return out


def by_metadata(values: list[list[str]], speaks: dict[str, int]) -> np.ndarray:
    """The subject that a document's metadata speaks for, -1 where it is silent or of two minds."""
    out = np.full(len(values), -1)
    for i, own in enumerate(values):
        found = {speaks[v] for v in own if v in speaks}
        if len(found) == 1:
            out[i] = found.pop()
    return out


def train(examples: list[tuple[str, str]], texts: list[tuple] = (), rounds: int = 2) -> Model:
    """A model from labelled passages and, for wider vocabulary, from texts (text, source, type) without labels, in ``rounds`` rounds."""
    subjects = sorted({s for _, s in examples})
    label = np.array([subjects.index(s) for _, s in examples])
    sents, owner = prepare([t for t, _ in examples])
    x = Design(sents)
    at = thresholds(x, owner, label, len(subjects))
    w, small = refined(x, label[owner], owner, len(subjects))
    model = Model(subjects, small.used, w, at)
    split = [(own, metadata(*t)) for t in texts if len(own := sentences(t[0])) >= 3] if rounds else []
    if not split:
        return model
    lists, values = [own for own, _ in split], [v for _, v in split]
    flat = [s for own in lists for s in own]
    doc = np.repeat(np.arange(len(lists)), [len(own) for own in lists])
    slots = [list({slot(g) for g in grams(s)}) for s in flat]
    for _ in range(rounds):
        named = labels_of(model.scores_of(slots) >= 0, slots, doc, len(lists))
        speaks = leaning(values, named, subjects)
        told = by_metadata(values, speaks)
        named = np.where(((named < 0) | (named == len(subjects))) & (told >= 0), told, named)
        kept: dict[str, int] = {}  # a sentence counts once, however many copies of its text there are
        for k in np.flatnonzero(named[doc] >= 0):
            kept.setdefault(flat[k], k)
        rows = list(kept.values())
        if not rows:
            break
        x = Design(sents + [slots[k] for k in rows], 3)
        unit = np.r_[owner, len(label) + np.arange(len(rows))]
        w, small = refined(x, np.r_[label[owner], named[doc[rows]]], unit, len(subjects), PURE)
        model = Model(subjects, small.used, w, at)
        model.values, model.speaks = len({v for own in values for v in own}), speaks
    return model


def labels_of(hits: np.ndarray, slots: list[list[int]], doc: np.ndarray, docs: int) -> np.ndarray:
    """The subject that stands out in each text, their number for texts of no subject, -1 where that cannot be told.

    A sentence without a subject is open, not neutral, where its n-grams are mostly met in sentences with one: it may be
    about something for which words are still missing. Texts with many open sentences are never taken as neutral, and
    they take a subject that is the only one found in them.
    """
    some = hits.any(axis=1)
    sizes = [len(x) for x in slots]
    row = np.repeat(np.arange(len(slots)), sizes)
    _, place, n = np.unique(np.fromiter(itertools.chain.from_iterable(slots), np.int64, sum(sizes)), return_inverse=True, return_counts=True)
    frame = (n >= FRAME) & (np.bincount(place, some[row], len(n)) >= 0.8 * n)
    still_open = ~some & (np.bincount(row, frame[place], len(slots)) >= 2)
    total = np.bincount(doc, minlength=docs)
    share = np.stack([np.bincount(doc, hits[:, k], docs) / total for k in range(hits.shape[1])], axis=1)
    opened = np.bincount(doc, still_open, docs) / total
    first = share.max(axis=1)
    second = np.sort(share, axis=1)[:, -2] if hits.shape[1] > 1 else np.zeros(docs)
    out = np.full(docs, -1)
    out[(first < NEUTRAL) & (opened < NEUTRAL)] = hits.shape[1]
    clear = (second < NEUTRAL) & ((first >= LABELLED) | (first > 0) & (second == 0) & (opened >= LABELLED))
    out[clear] = share[clear].argmax(axis=1)
    return out


def fitted(docs: DataFrame, examples: DataFrame, folder: str | None = None) -> Model | None:
    """The model for some examples (text, subject) and documents (doc_id, text, source, doc_type); None without a labelled example.

    One task fits it on the two bounded samples. It is kept under the hash of these in ``folder``, by default the folder for
    checkpoints, and read from there when the same is asked again.
    """
    spark = docs.sparkSession
    labelled = examples.where("text IS NOT NULL AND subject IS NOT NULL").select("text", "subject").orderBy(F.xxhash64("text"), "subject").limit(EXAMPLES)
    lot = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30))
    share = min(1.0, 1.2 * SAMPLE / max(1, docs.count()))
    texts = docs.where((lot < int(share * (1 << 30))) & F.length("text").between(100, 4000)).orderBy(lot, "doc_id").limit(SAMPLE)
    none = F.lit(None).cast("string")
    rows = labelled.select("text", "subject", none.alias("source"), none.alias("doc_type")).union(texts.select("text", none, "source", "doc_type"))
    rows = rows.coalesce(1).sortWithinPartitions("subject", F.xxhash64("text"), "text", "source", "doc_type")
    if folder is None:
        ensure_checkpoint_dir(spark)
        folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/subjects"
    sign = rows.agg(F.sum(F.xxhash64("text", "subject", "source", "doc_type").cast("decimal(38,0)")), F.count("subject")).first()
    if not sign[1]:
        return None
    at = f"{folder}/{sign[0]}-{sign[1]}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        pairs = [(t, s) for t, s, *_ in got if s is not None]
        if pairs:
            model = train(pairs, [(t, a, d) for t, s, a, d in got if s is None])
            model.memory = {}
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    try:
        kept = spark.read.parquet(at)
    except AnalysisException:
        rows.mapInArrow(run, "model binary").write.mode("overwrite").parquet(at)
        kept = spark.read.parquet(at)
    return pickle.loads(kept.first()[0])


def subjects_of(docs: DataFrame, examples: DataFrame, folder: str | None = None) -> DataFrame:
    """(doc_id, subject) of the documents (doc_id, text and, if known, source and doc_type), with a model fitted on the examples (text, subject)."""
    for c in ("source", "doc_type"):
        docs = docs if c in docs.columns else docs.withColumn(c, F.lit(None).cast("string"))
    found = fitted(docs, examples, folder)
    if found is None:
        return docs.select("doc_id", F.lit(None).cast("string").alias("subject")).where(F.lit(False))
    model = docs.sparkSession.sparkContext.broadcast(found)  # bounded by the two samples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        names = pa.array(m.subjects, pa.string())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                which, subject = m.classify(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(which)), names.take(pa.array(subject))], ["doc_id", "subject"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, subject string")
