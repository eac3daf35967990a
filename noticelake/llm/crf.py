"""Language of words in code-switched text by a linear-chain conditional random field.

A word's score for each language is the sum of hashed weights of its affixes, its byte n-grams, the
word itself and the languages of a lexicon that hold it; learned transitions score neighbours.
Forward-backward gives each word's probabilities, their mean over the words with letters those of
the text, and the runs of the likeliest language its code-switched stretches.

The model is fitted on a bounded sample: about ``DOCS`` labelled documents of each language, drawn by
a hash of their ids, ``STRETCHES`` stretches of ``WORDS`` words from all over each text. Training sequences
join stretches of different languages, so transitions are learned from switches.

Texts of one batch are worked on together: cut into chunks whose transfer matrices are multiplied
side by side and then joined in order, which gives the exact sums over whole texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.llm.words import mix, slices, split_words, text_bytes, word_hashes

DOCS, STRETCHES, WORDS, JOINED, EPOCHS, BATCH = 500, 6, 24, 4, 4, 64
BUCKETS, LEXICON, CHUNK = 1 << 18, 50_000, 128
UNKNOWN = "und"


# ---------------------------------------------------------------- features
def word_table(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Words of lower-cased texts: code of each word, texts' first words, the distinct words and their hashes."""
    data, off = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    start, end, first = split_words(data, off)
    codes, names = pd.factorize(word_hashes(data, start, end))
    sample = np.empty(len(names), np.int64)
    sample[codes[::-1]] = np.arange(len(codes))[::-1]
    raw = data.tobytes()
    return codes, first, [raw[a:b] for a, b in zip(start[sample].tolist(), end[sample].tolist())], names


def features(words: list[bytes], names: np.ndarray, lexicon: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weight indices of all words one after the other, and each word's first place (one more at the end)."""
    size = np.array([len(w) + 2 for w in words], np.int64)
    data = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint64)
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    left = size[owner] - (np.arange(len(data)) - first[owner])  # bytes from here to the end of the word
    index, belongs = [], []

    def add(values: np.ndarray, of: np.ndarray, kind: int) -> None:
        index.append((mix(values ^ np.uint64(kind << 56)) & np.uint64(BUCKETS - 1)).astype(np.int64))
        belongs.append(of)

    key = data.copy()
    for n in range(2, 6):
        key[: len(data) - n + 1] |= data[n - 1 :] << np.uint64(8 * (n - 1))
        at = np.flatnonzero(left >= n)
        if n < 5:
            add(key[at], owner[at], n)
        add(key[at[left[at] == size[owner[at]]]], owner[at[left[at] == size[owner[at]]]], 16 + n)
        add(key[at[left[at] == n]], owner[at[left[at] == n]], 32 + n)
    everyone = np.arange(len(words))
    add(names.astype(np.uint64), everyone, 64)
    known, tongues = lexicon
    if len(known):
        at = np.minimum(np.searchsorted(known, names), len(known) - 1)
        add(np.where(known[at] == names, tongues[at], 0).astype(np.uint64), everyone, 65)
    add(np.zeros(len(words), np.uint64), everyone, 66)
    belongs_all, index_all = np.concatenate(belongs), np.concatenate(index)
    order = np.argsort(belongs_all, kind="stable")
    return index_all[order], np.searchsorted(belongs_all[order], np.arange(len(words) + 1))


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: tuple[np.ndarray, np.ndarray]

    def scores(self, words: list[bytes], names: np.ndarray) -> np.ndarray:
        index, place = features(words, names, self.lexicon)
        return np.add.reduceat(self.weights[index], place[:-1], axis=0) if len(words) else np.zeros((0, len(self.labels)))


# ---------------------------------------------------------------- forward-backward
def _unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=tuple(range(1, x.ndim)), keepdims=True)


def marginals(emit: np.ndarray, first: np.ndarray, transitions: np.ndarray, chunk: int = CHUNK, pairs: np.ndarray | None = None) -> np.ndarray:
    """Probabilities of each word's labels; ``first`` holds the texts' first words (one more at the end).

    The state before the first word and after the last is free. To ``pairs`` (labels by labels) the expected number of each
    transition is added, those out of the free states included.
    """
    n, labels = emit.shape
    if not n:
        return emit
    a = np.exp(transitions - transitions.max())
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    size = np.diff(first)
    chunks = -(-size // chunk)
    of = np.repeat(np.arange(len(size)), chunks)
    number = np.arange(len(of)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    begin = first[:-1][of] + number * chunk
    length = np.minimum(chunk, first[1:][of] - begin)
    step = np.arange(min(chunk, int(length.max())))
    inside = step[None] < length[:, None]
    x = np.ones((len(of), len(step), labels))
    x[inside] = e[(begin[:, None] + step[None])[inside]]

    whole = np.broadcast_to(np.eye(labels), (len(of), labels, labels)).copy()
    for t in step:
        on = inside[:, t]
        whole[on] = _unit((whole[on] @ a) * x[on, t][:, None, :])
    head = np.ones((len(of), labels)) / labels
    tail = np.ones((len(of), labels)) / labels
    by_number = [np.flatnonzero(number == k) for k in range(int(number.max()) + 1)]
    for rows in by_number[1:]:
        head[rows] = _unit(np.einsum("ij,ijk->ik", head[rows - 1], whole[rows - 1]))
    for rows in reversed(by_number[1:]):
        tail[rows - 1] = _unit(np.einsum("ijk,ik->ij", whole[rows], tail[rows]))

    out = np.empty_like(x)
    before = head.copy()
    for t in step:
        on = inside[:, t]
        head[on] = _unit((head[on] @ a) * x[on, t])
        out[:, t] = head
    for t in reversed(step):
        on = inside[:, t]
        if pairs is not None:
            came = out[on, t - 1] if t else before[on]
            pairs += _unit(came[:, :, None] * a * (x[on, t] * tail[on])[:, None, :]).sum(axis=0)
        out[on, t] = _unit(out[on, t] * tail[on])
        tail[on] = _unit((tail[on] * x[on, t]) @ a.T)
    return out[inside]


# ---------------------------------------------------------------- training
def gradient(emit: np.ndarray, truth: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the negative log-likelihood of ``truth`` by scores and by transitions: expected minus observed.

    The state before a first word is not observed; what it is expected to be given that word stands for it.
    """
    n, labels = emit.shape
    expected, observed = np.zeros((labels, labels)), np.zeros((labels, labels))
    by_score = marginals(emit, first, transitions, pairs=expected).copy()
    by_score[np.arange(n), truth] -= 1
    starts = np.unique(first[first < n])
    follows = np.setdiff1d(np.arange(1, n), starts)
    np.add.at(observed, (truth[follows - 1], truth[follows]), 1.0)
    free = np.exp(transitions - transitions.max(axis=0))
    observed += (free / free.sum(axis=0)) * np.bincount(truth[starts], minlength=labels)
    return by_score, expected - observed


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches at even distances over each whole text."""
    for batch in batches:
        lang, out = [], []
        for text, tongue, h in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "h"))):
            words = [w.decode("utf-8", "replace") for w in text.encode().split()]
            step = max(WORDS, len(words) // STRETCHES)
            for at in range(abs(h) % max(1, step - WORDS + 1), len(words), step):
                lang.append(tongue)
                out.append(" ".join(words[at : at + WORDS]))
        yield pa.RecordBatch.from_pydict({"lang": pa.array(lang, pa.string()), "words": pa.array(out, pa.string())})


def sample(docs: DataFrame, seed: int) -> pd.DataFrame:
    """Stretches of about ``DOCS`` documents of each language; ``docs`` is (id, text, lang) with text and language set."""
    counts = docs.groupBy("lang").count().collect()  # one row a language: the model's labels
    h = F.xxhash64("id", F.lit(seed))
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, DOCS / r["count"]))]) if counts else None
    drawn = docs.where(F.pmod(h, F.lit(1 << 40)) < share[F.col("lang")] * float(1 << 40)) if counts else docs.limit(0)
    return drawn.select("text", "lang", h.alias("h")).mapInArrow(_stretches, "lang string, words string").toPandas()


def fit(stretches: pd.DataFrame, seed: int = 5) -> Model:
    labels = sorted(stretches["lang"].unique())
    stretches = stretches.sort_values(["lang", "words"], kind="stable").reset_index(drop=True)
    codes, first, words, names = word_table(pa.array(stretches["words"], pa.string()))
    kept = np.flatnonzero(np.diff(first) > 0)
    truth = stretches["lang"].map({x: i for i, x in enumerate(labels)}).to_numpy()
    size, n = np.diff(first), len(labels)
    if not len(kept):
        return Model(labels, np.zeros((BUCKETS, n), np.float32), np.zeros((n, n)), (np.zeros(0, np.uint64), np.zeros(0, np.int64)))

    seen = np.zeros((len(words), n))
    np.add.at(seen, (codes, np.repeat(truth, size)), 1.0)
    share = seen / np.maximum(seen.sum(axis=0), 1)
    holds = (share >= 0.5 * share.max(axis=1, keepdims=True)) & (share > 0)
    often = np.argsort(-seen.sum(axis=1), kind="stable")[:LEXICON]
    often = often[seen[often].sum(axis=1) >= 3]
    often = often[np.argsort(names[often])]
    # languages beyond the 62nd share bits, which makes the feature coarser and nothing else
    lexicon = names[often], (holds[often] << (np.arange(n) % 62)).sum(axis=1)

    index, place = features(words, names, lexicon)
    width = np.diff(place)
    weights, trans = np.zeros((BUCKETS, n)), np.zeros((n, n))
    weight_sq, trans_sq = np.full((BUCKETS, n), 1e-6), np.full((n, n), 1e-6)
    rng = np.random.Generator(np.random.PCG64(seed))
    by_label = [kept[truth[kept] == i] for i in range(n)]
    per = max(map(len, by_label))
    for _ in range(EPOCHS):
        drawn = np.concatenate([rng.permutation(np.resize(rng.permutation(b), per)) for b in by_label if len(b)])
        rng.shuffle(drawn)
        for at in range(0, len(drawn), BATCH * JOINED):
            part = drawn[at : at + BATCH * JOINED]
            w = np.concatenate([codes[first[s] : first[s + 1]] for s in part])
            y = np.repeat(truth[part], size[part])
            ends = np.cumsum(size[part])
            cut = np.unique(np.concatenate([[0], ends[JOINED - 1 :: JOINED], ends[-1:]]))
            used, inverse = np.unique(w, return_inverse=True)
            rows = np.concatenate([index[place[u] : place[u + 1]] for u in used])
            emit = np.add.reduceat(weights[rows], np.cumsum(width[used]) - width[used], axis=0)[inverse]
            wrong, gt = gradient(emit, y, cut, trans)
            per_word = np.zeros((len(used), n))
            np.add.at(per_word, inverse, wrong / len(cut))
            touched, where = np.unique(rows, return_inverse=True)
            g = np.zeros((len(touched), n))
            np.add.at(g, where, np.repeat(per_word, width[used], axis=0))
            weight_sq[touched] += g * g
            weights[touched] -= 0.1 * g / np.sqrt(weight_sq[touched])
            gt /= len(y)
            trans_sq += gt * gt
            trans -= 0.1 * gt / np.sqrt(trans_sq)
    return Model(labels, weights.astype(np.float32), trans, lexicon)


# ---------------------------------------------------------------- Spark
RESULT = "lang_pred string, score double, segments array<struct<lang:string,first:int,last:int>>"


def label(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (id, held_out, text) as (id, held_out, lang_pred, score, segments); segments are runs of words, counted from 0."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        names = np.array([*m.labels, UNKNOWN], object)
        for batch in batches:
            for part in slices(batch, "text"):
                text = pc.fill_null(part.column("text"), "")
                codes, first, words, hashes = word_table(text)
                n = len(text)
                best, score, segments = np.full(n, len(m.labels)), np.zeros(n), [[] for _ in range(n)]
                if len(codes) and m.labels:
                    lettered = pc.match_substring_regex(pa.array([w.decode("utf-8", "replace") for w in words]), r"\p{L}").to_numpy(zero_copy_only=False)
                    p = marginals(m.scores(words, hashes)[codes].astype(float), first, m.transitions)
                    weight = lettered[codes].astype(float)
                    sums = np.zeros((n, len(m.labels) + 1))
                    doc = np.repeat(np.arange(n), np.diff(first))
                    for j in range(len(m.labels)):
                        sums[:, j] = np.bincount(doc, p[:, j] * weight, n)
                    sums[:, -1] = np.bincount(doc, weight, n)
                    some = sums[:, -1] > 0
                    best[some] = sums[some, :-1].argmax(axis=1)
                    score[some] = np.clip(sums[some, best[some]] / sums[some, -1], 0, 1)
                    likely = p.argmax(axis=1)
                    new = np.append(True, (likely[1:] != likely[:-1]) | (doc[1:] != doc[:-1]))
                    at = np.flatnonzero(new)
                    last = np.append(at[1:], len(doc)) - 1
                    for i, j, d in zip(at.tolist(), last.tolist(), doc[at].tolist()):
                        if some[d]:
                            segments[d].append({"lang": m.labels[likely[i]], "first": i - int(first[d]), "last": j - int(first[d])})
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("held_out"), pa.array(names[best], pa.string()), pa.array(score), pa.array(segments, kind)],
                    ["id", "held_out", "lang_pred", "score", "segments"],
                )

    return rows.select("id", "held_out", "text").mapInArrow(run, f"id bigint, held_out boolean, {RESULT}")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held: int = 1, seed: int = 5) -> DataFrame:
    """Returns (id_col, held_out, lang_pred, score, segments), one row for each row of ``docs``.

    Learns from rows with id, text and language whose crc32 of the id as text leaves another remainder by
    ``folds`` than ``held``; predicts every row from its text alone. A null text, one without a letter, and
    every text if there is nothing to learn from is ``und`` with score 0 and no segments. A null id is not
    held out and not learned from. Ties go to the language that sorts first. Repeated rows get equal
    results. Other columns are not read. An empty table gives an empty result.
    """
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.coalesce(fold == held, F.lit(False)).alias("held_out")
    )
    model = fit(sample(rows.where("not held_out and id is not null and text is not null and lang is not null").select("id", "text", "lang"), seed))
    return label(rows, model).withColumnRenamed("id", id_col)


