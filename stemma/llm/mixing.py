"""Mixing sources to target weights of the total tokens.

1. *Posteriors.*  A multinomial model over the tokens of texts is fitted on a bounded sample of the documents that
   state their source.  Every document gets a posterior over the sources from the model and from what it
   states, which is taken to be right with probability ``trust``; it is a soft member of every source.
2. *Rates.*  Every document has its own rate between 0 and the repeats its source is allowed.  Projected gradient
   with momentum on the least squares between expected source totals and targets: in every round all
   documents are asked for their share of the totals, the sums go back as one gradient, and each document takes
   the step its posterior and bounds allow.  No rate is ever stored; a document follows the short list of
   gradients.
3. *Whole numbers.*  A rate is rounded up or down by the document's hash.  One shift a source, read off a
   histogram of what rounding leaves, brings the source's tokens to its target.

The total aimed at is the largest at which no source runs out.

Defined results: null and empty texts have no tokens, the prior as text evidence, and are used as often as their rate
says; documents without source count for the source they most likely belong to; sources without target are not
used; a target without documents stays at share 0; equal documents count as often as they occur; targets that
sum to another value than 1 are scaled to 1; a source without a bound on repeats (null) may be repeated without
end, and if that holds for all, documents are used once on average; without documents or targets nothing is used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm import tokens
from stemma.session import cut

DIM = 1 << 16
BINS = 1024
MAX_TRAIN = 4_000
FREE = 1e6


def fit(labelled: DataFrame, source: str, text: str, sources: list[str], sizes: dict[str, int], path: str, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, np.ndarray]:
    """(log priors, log likelihoods by source and token) from about ``max_train`` documents a source, taken by hash.

    Token counts are summed on the cluster; what arrives has at most sources x DIM rows.
    """
    share = F.create_map(*[x for s in sources for x in (F.lit(s), F.lit(min(1.0, max_train / max(sizes.get(s, 0), 1))))])[F.col(source)]
    sample = labelled.where(F.pmod(F.xxhash64(text, F.lit("train")), F.lit(1 << 30)) < share * (1 << 30))
    place = F.create_map(*[x for i, s in enumerate(sources) for x in (F.lit(s), F.lit(i))])[F.col(source)].alias("s")
    ids = sample.select(place, F.explode(tokens.token_ids(F.col(text), path)).alias("w")).select("s", F.pmod("w", F.lit(DIM)).alias("w"))
    counts = ids.groupBy("s", "w").agg(F.count(F.lit(1)).alias("c")).toPandas()
    like = np.full((len(sources), DIM), 0.05)
    like[counts["s"].to_numpy(int), counts["w"].to_numpy(int)] += np.sqrt(counts["c"].to_numpy(float))
    prior = np.array([sizes.get(s, 0) + 1.0 for s in sources])
    return np.log(prior / prior.sum()), np.log(like / like.sum(axis=1, keepdims=True))


def posterior(ids: list[int], stated: int, prior: np.ndarray, like: np.ndarray, trust: float) -> np.ndarray:
    """Posterior over the sources; ``stated`` is the place of the source the document states, or -1."""
    z = prior.copy()
    if ids:
        # tokens of one text are not independent: their evidence grows with the root of their number
        z += like[:, np.asarray(ids, dtype=np.int64) % DIM].sum(axis=1) / len(ids) ** 0.5
    p = np.exp(z - z.max())
    if stated >= 0:
        wrong = (1 - trust) * np.exp(prior[stated])
        p = p * (np.where(np.arange(len(p)) == stated, trust, 0.0) + wrong)
    return p / p.sum()


def members(docs: DataFrame, doc_id: str, source: str, text: str, sources: list[str], model: tuple[np.ndarray, np.ndarray], trust: float, path: str) -> DataFrame:
    """(doc_id, stated, own, n, p): the place of the document's source (-1: none with a target), tokens and posterior."""
    shared = docs.sparkSession.sparkContext.broadcast((*model, {s: i for i, s in enumerate(sources)}))
    kind = docs.schema[doc_id].dataType.simpleString()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = tokens.encoding(path)
        prior, like, place = shared.value
        for b in batches:
            own, n, p = [], [], []
            for s, t in zip(b["s"], b["t"]):
                ids = enc.encode_ordinary(t) if isinstance(t, str) else []
                stated = place.get(s, -1) if isinstance(s, str) else -1
                q = posterior(ids, stated, prior, like, trust)
                own.append(stated if isinstance(s, str) else int(q.argmax()))
                n.append(len(ids))
                p.append(q.astype(np.float32))
            yield pd.DataFrame({"k": b["k"], "stated": b["s"], "own": np.array(own, dtype=np.int32), "n": np.array(n, dtype=np.int64), "p": p})

    src = docs.select(F.col(doc_id).alias("k"), F.col(source).alias("s"), F.col(text).alias("t"))
    return src.mapInPandas(rows, f"k {kind}, stated string, own int, n bigint, p array<float>").withColumnRenamed("k", doc_id)


def follow(p: np.ndarray, caps: np.ndarray, gradients: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(rates, points of the next step) of documents after the gradients so far; one row of ``p`` a document."""
    x = y = np.minimum(1.0, caps)
    t = 1.0
    for g in gradients:
        new = np.clip(y - p @ g, 0.0, caps)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = np.clip(new + (t - 1) / t2 * (new - x), 0.0, caps)
        x, t = new, t2
    return x, y


def _summed(member: DataFrame, caps: np.ndarray, gradients: list[np.ndarray], with_matrix: bool) -> np.ndarray:
    """Sums over all documents: expected totals by source, their number of tokens and, once, the matrix of the least squares."""
    size = len(caps)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size + (size * size if with_matrix else 0))
        for b in batches:
            b = b[b["own"] >= 0]
            if b.empty:
                continue
            p, n = np.stack(b["p"].to_numpy()).astype(float), b["n"].to_numpy(float)
            _, y = follow(p, caps[b["own"].to_numpy()], gradients)
            total[:size] += (n * y) @ p
            if with_matrix:
                total[size:] += (p.T @ (n[:, None] * p)).ravel()
        yield pd.DataFrame({"i": np.arange(len(total), dtype=np.int32), "v": total})

    sums = member.select("own", "n", "p").mapInPandas(rows, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size + (size * size if with_matrix else 0))
    for r in sums:
        out[r["i"]] = r["v"]
    return out


def descend(member: DataFrame, goal: np.ndarray, caps: np.ndarray, rounds: int = 40, close: float = 2e-4) -> list[np.ndarray]:
    """Gradients of the projected descent, ended when expected totals are within ``close`` of the total or stand still."""
    size = len(goal)
    gradients: list[np.ndarray] = []
    first = _summed(member, caps, gradients, True)
    matrix = first[size:].reshape(size, size)
    # sources are weighed by their own size, so that small ones converge as fast as large ones
    weight = np.where(np.diag(matrix) > 0, 1 / np.maximum(np.diag(matrix), 1e-12), 0.0)
    root = np.sqrt(weight)
    step = 1 / max(np.linalg.eigvalsh(root[:, None] * matrix * root[None, :]).max(), 1e-12)
    expected, before = first[:size], np.inf
    for _ in range(rounds):
        off = expected - goal
        far = float(np.abs(off).max() / max(goal.sum(), 1e-12))
        if far < close or (len(gradients) > 8 and far > 0.999 * before):
            break
        before = min(before, far)
        gradients.append(step * weight * off)
        expected = _summed(member, caps, gradients, False)
    return gradients


def shifts(table: pd.DataFrame, goal: np.ndarray, caps: np.ndarray) -> list[tuple[int, float]]:
    """(shift in bins, share of the next bin) for every source: the tokens used come to the goal.

    table: own, bin, n, the tokens of the documents of one source by bin.
    """
    out = []
    for s in range(len(goal)):
        t = table[table["own"] == s]
        b, n = t["bin"].to_numpy(np.int64), t["n"].to_numpy(float)
        used = lambda j: float((n * np.clip((b + j) // BINS + 1, 0, caps[s])).sum())  # noqa: B023, E731
        low, high = -int(b.max(initial=0)) - BINS - 1, int(min(caps[s], FREE)) * BINS + BINS - int(b.min(initial=0)) + 1
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if used(mid) <= goal[s] else (low, mid)
        gap = used(low + 1) - used(low)
        out.append((low, float(np.clip((goal[s] - used(low)) / gap, 0, 1)) if gap > 0 else 0.0))
    return out


def mix(docs: DataFrame, doc_id: str, source: str, text: str, targets: DataFrame, trust: float = 0.95, path: str = tokens.VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens, times, membership): how often each document is used, 0 included.

    targets: source, target_share, max_repeats.  membership: posterior of the source the document counts for.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"{doc_id} {kind}, source string, n_tokens int, times int, membership double"
    rows = targets.where("source is not null and target_share is not null").collect()
    share: dict[str, float] = {}
    cap: dict[str, float] = {}
    for r in rows:
        share[r["source"]] = share.get(r["source"], 0.0) + max(r["target_share"], 0.0)
        cap[r["source"]] = max(cap.get(r["source"], 0.0), FREE if r["max_repeats"] is None else float(r["max_repeats"]))
    sources = sorted(share)
    if not sources or sum(share.values()) == 0:
        n = tokens.n_tokens(F.col(text), path)
        return docs.select(doc_id, F.col(source).alias("source"), n.alias("n_tokens"), F.lit(0).alias("times"), F.lit(None).cast("double").alias("membership"))
    aim = np.array([share[s] for s in sources]) / sum(share.values())
    caps = np.array([cap[s] for s in sources])
    docs = docs.select(doc_id, source, text)
    sizes = {r[source]: r["c"] for r in docs.where(F.col(source).isin(sources)).groupBy(source).agg(F.count(F.lit(1)).alias("c")).collect()}
    model = fit(docs.where(F.col(source).isin(sources)), source, text, sources, sizes, path)
    member = cut(members(docs, doc_id, source, text, sources, model, trust, path))
    own = {r["own"]: r["n"] for r in member.where("own >= 0").groupBy("own").agg(F.sum("n").alias("n")).collect()}
    have = np.array([float(own.get(i, 0) or 0) for i in range(len(sources))])
    usable = (aim > 0) & (have > 0)
    total = ((have * caps)[usable] / aim[usable]).min() if usable.any() else 0.0
    if usable.any() and (caps[usable] >= FREE).all():
        total = have.sum()
    goal = np.where(usable, np.minimum(aim * total, have * caps), 0.0)
    gradients = descend(member, goal, caps) if total > 0 else []

    def placed(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        p = np.stack(b["p"].to_numpy()).astype(float)
        rates, _ = follow(p, caps[b["own"].to_numpy()], gradients)
        return np.floor((rates - b["h"].to_numpy()) * BINS).astype(np.int64), p

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b[b["own"] >= 0]
            if not b.empty:
                yield pd.DataFrame({"own": b["own"], "bin": placed(b)[0], "n": b["n"]})

    # two hashes of the document: one rounds its rate, the finer one shares out the last bin
    unit = lambda salt: F.pmod(F.xxhash64(F.col(doc_id), F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    hashed = member.select(doc_id, "stated", "own", "n", "p", unit("round").alias("h"), unit("fine").alias("fine"))
    spread = hashed.mapInPandas(bins, "own int, bin bigint, n bigint").groupBy("own", "bin").agg(F.sum("n").alias("n")).toPandas()
    moved = shifts(spread, goal, caps)

    def used(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shift, part = np.array([m[0] for m in moved]), np.array([m[1] for m in moved])
        for b in batches:
            out = pd.DataFrame({"k": b[doc_id], "source": b["stated"], "n_tokens": b["n"].astype("int32"), "times": 0, "membership": np.nan})
            hit = (b["own"] >= 0).to_numpy()
            if hit.any():
                c = b[hit]
                o = c["own"].to_numpy()
                at, p = placed(c)
                at = at + shift[o] + (c["fine"].to_numpy() < part[o])
                out.loc[hit, "source"] = np.array(sources, dtype=object)[o]
                out.loc[hit, "times"] = np.clip(at // BINS + 1, 0, caps[o]).astype(int)
                out.loc[hit, "membership"] = p[np.arange(len(o)), o]
            yield out.rename(columns={"k": doc_id}).astype({"times": "int32"})

    return hashed.mapInPandas(used, schema)
