"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad. A line's features are its own,
those of the line before and of the line after. The chain is fitted on labelled
documents whose lines all carry the document's label; a document's score is the
mean of its lines' marginal probabilities of being good, from forward-backward,
weighted by line length, and then set by a logistic curve. The fit sees all lines:
a document of more than CHAIN lines is cut into chains for it, whose lines keep the
features of their neighbours; the curve is fitted on the means of whole documents.

The fit uses at most ``bound`` labelled documents, chosen by a hash of their id;
all of them up to that number. Rows without doc_id or label are not learned from;
of several labels of one document the largest counts. A text without words gets
the score of the empty feature sum, which the curve's offset gives. Without any
labelled row every score is 0.5. Rows are scored one by one: repeated rows and
other columns change nothing, and an empty table gives an empty result.
"""

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.text import in_arrow, remainder, texts

N_OWN = 13
N_ALL = 3 * N_OWN + 3
#: Lines of a chain in the fit; scoring takes whole documents.
CHAIN = 200
DELETE_UPPER = bytes(range(65, 91))
SYMBOLS = b"#*$%&|<>{}[]\\^~_=+@"


def line_features(line: bytes, words: list[bytes], earlier: bool) -> list[float]:
    n, size = len(words), len(line)
    letters = line.translate(None, b" \t\r\x0b\x0c.,;:'\"-()?!0123456789" + SYMBOLS)
    upper = len(letters) - len(letters.translate(None, DELETE_UPPER))
    symbols = size - len(line.translate(None, SYMBOLS))
    marks = line.count(b"!") + line.count(b"?")
    digits = size - len(line.translate(None, b"0123456789"))
    points = line.count(b".") + line.count(b",")
    distinct = len(set(words))
    return [
        1.0,
        upper / (len(letters) + 1),
        min(1.0, 3 * symbols / size),
        min(1.0, 3 * marks / size),
        digits / size,
        min(1.0, 5 * points / size),
        min(1.0, 2 * line.count(b"|") / n),
        1 - distinct / n,
        max(0.0, 1 - 2 * distinct / n),
        1.0 if earlier else 0.0,
        min(2.0, math.log1p(n) / 4),
        min(2.0, (size / n) / 10),
        1.0 if n < 3 else 0.0,
    ]


def document_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines with words (own, before, after, first, last, single) and their lengths."""
    own, sizes, before = [], [], set()
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            own.append(line_features(line, words, line in before))
            sizes.append(len(line))
            before.add(line)
    n = len(own)
    out = np.zeros((n, N_ALL))
    if n:
        out[:, :N_OWN] = own
        out[1:, N_OWN : 2 * N_OWN] = out[:-1, :N_OWN]
        out[:-1, 2 * N_OWN : 3 * N_OWN] = out[1:, :N_OWN]
        out[0, -3] = out[-1, -2] = 1.0
        out[:, -1] = n == 1
    return out, np.array(sizes, float)


def marginals(scores: np.ndarray, switch: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over (documents, lines): P(good), expected transitions, log partition.

    ``scores`` are the log potentials of good against bad, ``switch`` the 2 x 2
    log potentials of a pair of neighbouring states.
    """
    docs, lines = scores.shape
    node = np.stack([np.zeros_like(scores), scores], 2)
    forward, backward = np.zeros((docs, lines, 2)), np.zeros((docs, lines, 2))
    forward[:, 0] = node[:, 0]
    for t in range(1, lines):
        step = np.logaddexp.reduce(forward[:, t - 1, :, None] + switch, 1) + node[:, t]
        forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
    for t in range(lines - 2, -1, -1):
        step = np.logaddexp.reduce(switch + (node[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(mask[:, t + 1, None], step, 0)
    total = np.logaddexp.reduce(forward[:, -1], 1)
    good = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None]) * mask
    pairs = np.zeros((docs, 2, 2))
    if lines > 1:
        joint = (
            forward[:, :-1, :, None] + switch + (node[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        pairs = (np.exp(joint) * mask[:, 1:, None, None]).sum(1)
    return good, pairs, total


def fit(features: list[np.ndarray], sizes: list[np.ndarray], labels: np.ndarray, rounds: int = 80) -> dict:
    """Maximum likelihood by Adam, with a small penalty; then the logistic curve of the score."""
    weight, switch = np.zeros(N_ALL), np.zeros((2, 2))
    chains = [(f[at : at + CHAIN], y) for f, y in zip(features, labels) for at in range(0, len(f), CHAIN)]
    order = sorted(range(len(chains)), key=lambda i: len(chains[i][0]))
    packs = []
    for part in np.array_split(np.array(order, int), max(1, len(order) // 256)):
        if not len(part):
            continue
        lines = len(chains[part[-1]][0])
        x, mask = np.zeros((len(part), lines, N_ALL)), np.zeros((len(part), lines), bool)
        for row, i in enumerate(part):
            n = len(chains[i][0])
            x[row, :n], mask[row, :n] = chains[i][0], True
        packs.append((x, mask, np.array([chains[i][1] for i in part])))
    n_lines = sum(m.sum() for _, m, _ in packs) or 1
    moment, square = np.zeros(N_ALL + 4), np.zeros(N_ALL + 4)
    for k in range(1, rounds + 1):
        step, step2 = np.zeros(N_ALL), np.zeros((2, 2))
        for x, mask, y in packs:
            good, pairs, _ = marginals(x @ weight, switch, mask)
            want = mask * y[:, None]
            step += ((want - good)[:, :, None] * x).sum((0, 1))
            both = (mask[:, 1:].sum(1)) if mask.shape[1] > 1 else np.zeros(len(y))
            step2[1, 1] += (both * y).sum()
            step2[0, 0] += (both * (1 - y)).sum()
            step2 -= pairs.sum(0)
        slope = np.concatenate([step, step2.ravel()]) / n_lines - 1e-4 * np.concatenate([weight, switch.ravel()])
        moment, square = 0.9 * moment + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        move = 0.15 * (moment / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-9)
        weight, switch = weight + move[:N_ALL], switch + move[N_ALL:].reshape(2, 2)
    raw = np.array([mean_good(f, s, weight, switch) for f, s in zip(features, sizes)])
    curve = np.zeros(2)
    x = np.stack([np.ones(len(raw)), raw - 0.5], 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (labels - p) - 0.5 * np.array([0, curve[1]])
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 0.5])
        curve = np.clip(curve + np.linalg.solve(bend, slope), -12, 12)
    return {"weight": weight, "switch": switch, "curve": curve}


def mean_good(features: np.ndarray, sizes: np.ndarray, weight: np.ndarray, switch: np.ndarray) -> float:
    """Length-weighted mean of P(good) over the lines of one document; 0.5 without lines."""
    n = len(features)
    if not n:
        return 0.5
    score = (features @ weight).tolist()
    (bb, bg), (gb, gg) = switch.tolist()
    # log odds of good from the lines before and from those after
    ahead, behind = [0.0] * n, [0.0] * n
    for t in range(1, n):
        odds = score[t - 1] + ahead[t - 1]
        ahead[t] = _lse(bg, gg + odds) - _lse(bb, gb + odds)
    for t in range(n - 2, -1, -1):
        odds = score[t + 1] + behind[t + 1]
        behind[t] = _lse(gb, gg + odds) - _lse(bb, bg + odds)
    odds = np.clip(np.array(score) + ahead + behind, -50, 50)
    return float(((1 / (1 + np.exp(-odds))) * sizes).sum() / sizes.sum())


def _lse(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def learn(docs: DataFrame, labels: DataFrame, bound: int = 6000) -> dict | None:
    """Fit on at most ``bound`` labelled documents outside the held-out fold."""
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .filter(remainder(F.col("doc_id"), 5) != 0)
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
    )
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    both = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id")

    def rows(batches):
        for batch in batches:
            for doc_id, quality, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch)):
                x, s = document_features(text)
                yield doc_id, quality, len(x), x.astype(np.float32).tobytes(), s.tobytes()

    chosen = both.select("doc_id", "quality", "text")
    found = in_arrow(chosen, rows, "doc_id long, quality int, n int, x binary, s binary").toPandas()
    if found.empty:
        return None
    found = found.sort_values(["doc_id", "n"], kind="stable")
    x = [np.frombuffer(b, np.float32).reshape(n, N_ALL).astype(float) for b, n in zip(found["x"], found["n"])]
    s = [np.frombuffer(b, float) for b in found["s"]]
    return fit(x, s, np.clip(found["quality"].to_numpy(float), 0, 1))


def score_of(text: bytes, model: dict | None) -> float:
    if not model:
        return 0.5
    raw = mean_good(*document_features(text), model["weight"], model["switch"])
    a, b = model["curve"].tolist()
    return 1 / (1 + math.exp(-(a + b * (raw - 0.5))))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, bound: int = 6000) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    model = learn(docs, labels, bound)

    def rows(batches):
        for batch in batches:
            for doc_id, fold, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch)):
                score = score_of(text, model)
                yield doc_id, fold == 0, score, int(score >= threshold)

    doc_id = F.col("doc_id").cast("long")
    picked = docs.select(doc_id.alias("doc_id"), remainder(doc_id, 5).alias("fold"), "text")
    return in_arrow(picked, rows, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, bound: int = 6000) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns; each by its own text."""
    model = learn(docs, labels, bound)

    def good(text):
        import pyarrow as pa

        return pa.array([score_of(x or b"", model) >= threshold for x in text.cast(pa.binary()).to_pylist()], pa.bool_())

    return docs.filter(F.arrow_udf(good, "boolean")("text"))
