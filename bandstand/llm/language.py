"""Language identification by error-correcting output codes.

Each language has a codeword of signs. For each place of the code a binary classifier over hashed letter n-grams
says which sign a text has; the language whose codeword loses least against the margins is chosen, each place
weighed by how well its classifier did. A text whose two best languages are close is marked as ambiguous.

The classifiers are fitted on a bounded sample of labelled rows; everything else reads all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from bandstand.llm.ragged import mix, text_slices

UNKNOWN = "und"
FEATURES = 4096
ROWS = 256  # texts whose features are held at once


@dataclass(frozen=True)
class LanguageRules:
    """Labelled rows of the sample (about, all languages together), fitting rounds, gap below which a text is ambiguous."""

    sample_rows: int = 2400
    rounds: int = 120
    segment_letters: int = 40
    gap: float = 0.2
    seed: int = 3


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points with each run of other signs as one zero, and offsets of the texts.

    Every text begins and ends with a zero.
    """
    blob = data.tobytes()
    texts = [blob[a:b].decode("utf-8").lower() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    sizes = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    cp = np.frombuffer(("\n" + "\n\n".join(texts) + "\n").encode("utf-32-le") if texts else b"", np.uint32)
    cp = np.where(_letters()[cp], cp, 0)
    text = np.repeat(np.arange(len(texts)), sizes)
    keep = np.ones(len(cp), bool)
    keep[1:] = (cp[1:] != 0) | (cp[:-1] != 0) | (text[1:] != text[:-1])
    counts = np.bincount(text[keep], minlength=len(texts))
    return cp[keep].astype(np.uint64), np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])


def _features(cp: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of n-gram shares, one row per text; zeros for a text without letters."""
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    out = np.zeros(n * FEATURES)
    for size in (2, 3):
        if len(cp) < size:
            break
        code = cp[: len(cp) - size + 1].copy()
        for k in range(1, size):
            code = code * np.uint64(0x110001) + cp[k : len(cp) - size + 1 + k]
        same = text[: len(code)] == text[size - 1 :]
        place = (mix(code) & np.uint64(FEATURES - 1)).astype(np.int64)
        out += np.bincount((text[: len(code)] * FEATURES + place)[same], minlength=n * FEATURES)
    out = out.reshape(n, FEATURES)
    total = out.sum(1, keepdims=True)
    out = np.sqrt(out / np.maximum(total, 1)).astype(np.float32)
    out[np.diff(offsets) < 3] = 0  # a letter needs three places: itself and a zero on either side
    return out


def codewords(classes: int, seed: int) -> np.ndarray:
    """A row of signs per class: all different splits up to seven classes, else the best of some random codes."""
    if classes <= 7:
        columns = [[1] + [1 if c >> k & 1 else -1 for k in range(classes - 1)] for c in range((1 << (classes - 1)) - 1)]
        return np.array(columns, np.int64).reshape(-1, classes).T
    rng = np.random.default_rng(seed)
    length = 10 * int(np.ceil(np.log2(classes)))
    best, best_distance = None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], (classes, length))
        distance = int(((length - code @ code.T) // 2 + length * np.eye(classes, dtype=np.int64)).min())
        if distance > best_distance and (abs(code.sum(0)) < classes).all():
            best, best_distance = code, distance
    return best


@dataclass(frozen=True)
class LanguageModel:
    """Languages, their codewords, one column of weights per place of the code, biases and trust in each place."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    gap: float

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: number of the language, score from 0 to 1, whether the two best are close."""
        n, k = len(x), len(self.languages)
        if k < 2:
            return np.zeros(n, np.int64), np.ones(n), np.zeros(n, bool)
        margin = x @ self.weights + self.bias
        losses = np.stack([(np.logaddexp(0, -margin * word) * self.trust).sum(1) for word in self.code], 1)
        best = losses.argmin(1)
        share = np.exp(-(losses - losses.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        ordered = np.sort(share, 1)
        return best, ordered[:, -1], ordered[:, -1] - ordered[:, -2] < self.gap


def _fit(x: np.ndarray, label: np.ndarray, languages: tuple[str, ...], rules: LanguageRules) -> LanguageModel:
    code = codewords(len(languages), rules.seed) if len(languages) > 1 else np.ones((1, 1), np.int64)
    target = code[label].astype(np.float32)
    weights, bias = np.zeros((FEATURES, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    ahead, ahead_bias, momentum, step = weights, bias, 0.0, 8.0
    for _ in range(rules.rounds if len(languages) > 1 else 0):
        pull = -target / (1 + np.exp(np.clip((x @ ahead + ahead_bias) * target, -30, 30))) / len(x)
        new, new_bias = ahead - step * (x.T @ pull + 1e-5 * ahead), ahead_bias - step * pull.sum(0)
        next_momentum = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        push = (momentum - 1) / next_momentum if momentum else 0.0
        ahead, ahead_bias = new + push * (new - weights), new_bias + push * (new_bias - bias)
        weights, bias, momentum = new, new_bias, next_momentum
    right = ((x @ weights + bias) * target > 0).mean(0) if len(x) else np.ones(code.shape[1])
    return LanguageModel(languages, code, weights, bias, np.maximum(right - 0.5, 0.01) / np.maximum(right - 0.5, 0.01).mean(), rules.gap)


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from; so is a row without an id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(True))


def train_language_model(docs: DataFrame, id_column: str, text_column: str, label_column: str, rules: LanguageRules = LanguageRules()) -> LanguageModel:
    """Fit on about ``rules.sample_rows`` labelled rows outside the held-out fold, as many of each language.

    Rows are drawn by a hash of the id, so reruns agree; each gives its whole text and a short segment of it. Rows
    without a text or a label are not learned from. Without any labelled row the model has no languages.
    """
    labelled = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), F.col(label_column).cast("string").alias("label"))
    labelled = labelled.where(F.col("text").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return LanguageModel((), np.zeros((0, 0)), np.zeros((FEATURES, 0)), np.zeros(0), np.zeros(0), rules.gap)
    languages = tuple(sorted(counts))
    each = max(1, rules.sample_rows // len(languages))
    share = F.element_at(F.create_map(*[F.lit(v) for label in languages for v in (label, min(1.0, each / counts[label]))]), F.col("label"))
    drawn = labelled.where(F.pmod(F.xxhash64("id", F.lit(rules.seed)), F.lit(1 << 40)) < share * float(1 << 40))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1), rows=ROWS):
                cp, at = _letter_runs(data, offsets)
                # The segment starts somewhere in the text, by its length.
                room = np.maximum(np.diff(at) - rules.segment_letters, 0)
                start = at[:-1] + (mix(np.diff(at).astype(np.uint64)) % (room + 1).astype(np.uint64)).astype(np.int64)
                short = [cp[s : min(s + rules.segment_letters, e)] for s, e in zip(start, at[1:])]
                short_at = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(s) for s in short])])
                for x in (_features(cp, at), _features(np.concatenate(short), short_at)):
                    rows = x.astype(np.float16)
                    labels = batch.column(0).slice(lo, hi - lo)
                    yield pa.RecordBatch.from_arrays([labels, pa.array([r.tobytes() for r in rows], pa.binary())], names=["label", "x"])

    rows = drawn.select("label", "text").mapInArrow(run, "label string, x binary").collect()
    number = {label: k for k, label in enumerate(languages)}
    rows.sort(key=lambda r: (r["label"], bytes(r["x"])))  # sums do not depend on the order of arrival
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in rows), np.float16).reshape(len(rows), FEATURES).astype(np.float32)
    label = np.array([number[r["label"]] for r in rows], np.int64)
    seen = x.any(1)
    return _fit(x[seen], label[seen], languages, rules)


def predict_languages(docs: DataFrame, id_column: str, text_column: str, model: LanguageModel, with_row: bool = False) -> DataFrame:
    """Per row ``doc_id, lang_pred, score, ambiguous``, and with ``with_row`` the whole row as the struct ``row``.

    A null text, one without letters, and any text if no language was learned is ``und`` with score 0. Whole texts
    are read; repeated rows are predicted one by one; a null id stays null.
    """
    row = [F.struct(*docs.columns).alias("row")] if with_row else []
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"), *row)
    names = np.array([*model.languages, UNKNOWN], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1), rows=ROWS):
                x = _features(*_letter_runs(data, offsets))
                known = x.any(1) & (len(model.languages) > 0)
                best, score, close = model.predict(x)
                best = np.where(known, best, len(model.languages))
                columns = [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array(names[best].tolist(), pa.string()),
                    pa.array(np.where(known, score, 0.0).astype(np.float64)),
                    pa.array(known & close),
                ]
                columns += [batch.column(2).slice(lo, hi - lo)] if with_row else []
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "ambiguous", "row"][: len(columns)])

    schema = "doc_id long, lang_pred string, score double, ambiguous boolean"
    if with_row:
        schema = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField("row", picked.schema["row"].dataType)])
    return picked.mapInArrow(run, schema)
