"""Hard-negative mining through a GNAT-style multiway tree over the embeddings.

Rows: ``embeddings`` (vec_id, embedding, label). A row with a null label, a null vector or any null or
non-finite component takes no part. Where vec_id is divisible by 7 the label becomes (label+1)%10.
Each component x becomes floor(256*x); a score is the integer inner product with an anchor; higher
scores first, ties by the smaller vec_id. Anchors: vec_id divisible by 100. Positives: an anchor's
first 5 rows of its label with another vec_id. Negatives of (anchor, positive): the first 10 rows of
another label with 30*positive_score <= 100*score <= 90*positive_score.

The tree. Inner products become distances by one more coordinate: a row x gets sqrt(M^2 - |x|^2),
where M is the largest norm of all rows, an anchor a gets 0; then |a - x|^2 = |a|^2 + M^2 - 2 a.x, so
a window of scores is an annulus of distances around the anchor. Split points are chosen on a bounded
sample (``SAMPLE`` rows by hash, farthest first: ``FANOUT`` at the top, ``FANOUT2`` inside each cell);
every row is placed in the cell of its nearest split point, at both levels. For every split point i
and sibling cell j the tree keeps the range of distances from i to all rows of j, over all rows (an
aggregate). A query drops a cell when the ring that the triangle inequality allows around some split
point misses the cell's range; the distance bounds give score bounds, with a slack for rounding.

Leaves are exact: the rows of a surviving leaf are scored in integers. Large leaves are cut into
chunks of about ``CHUNK`` rows by a hash of vec_id, and the queries of a leaf into blocks of about
``BLOCK``, so a leaf holding a third of all rows (one vector repeated) is many tasks. Each task keeps
its top 5 or top 10 per query; a window over the candidates of a query merges them.

Positives take two passes: the anchor's own leaf gives a lower bound of its fifth score, then every
leaf whose bound reaches it is searched. Negatives take one pass over the leaves whose score range
meets the window.

Defined cases: invalid rows take no part (also as anchors); rows with an anchor's vec_id are never
its positives; an anchor with no positive, or a positive with no negative, gives no rows; an empty
table gives an empty result; columns other than the three are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hushmark.llm.common import ship, table, written

SAMPLE = 4096
FANOUT = 16
FANOUT2 = 8
CHUNK = 2048
BLOCK = 256
POSITIVES = 5
NEGATIVES = 10
#: Fixed values of the contract: the window of negative scores, in hundredths of the positive score.
LOW_PCT, HIGH_PCT = 30, 90

OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def prepared(emb: DataFrame) -> DataFrame:
    """(vec_id, label, q) of the rows that take part, with the label turned and the components quantized."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    valid = emb.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ok)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    q = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("long"))
    return valid.select("vec_id", label.cast("long").alias("label"), q.alias("q"))


def _farthest(points: np.ndarray, k: int) -> np.ndarray:
    """Indices of up to k points, each the farthest from those chosen before (the first: index 0)."""
    if len(points) == 0:
        return np.zeros(0, int)
    chosen, near = [0], np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < min(k, len(points)) and near.max() > 0:
        nxt = int(near.argmax())
        chosen.append(nxt)
        near = np.minimum(near, np.linalg.norm(points - points[nxt], axis=1))
    return np.array(chosen)


def _lift(q: np.ndarray, m2: float, data: bool) -> np.ndarray:
    norms = (q.astype(np.float64) ** 2).sum(axis=1)
    extra = np.sqrt(np.maximum(m2 - norms, 0.0)) if data else np.zeros(len(q))
    return np.hstack([q.astype(np.float64), extra[:, None]])


class Tree:
    """Split points of two levels and, for each, the distance ranges to its sibling cells."""

    def __init__(self, m2: float, top: np.ndarray, inner: dict[int, np.ndarray]):
        self.m2, self.top, self.inner = m2, top, inner
        self.lo1 = self.hi1 = None
        self.lo2: dict[int, np.ndarray] = {}
        self.hi2: dict[int, np.ndarray] = {}

    def place(self, lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cell, leaf and the distances to the split points of both levels."""
        d1 = np.linalg.norm(lifted[:, None, :] - self.top[None, :, :], axis=2)
        cell = d1.argmin(axis=1)
        d2 = np.full((len(lifted), FANOUT2), np.nan)
        leaf = np.zeros(len(lifted), int)
        for c in np.unique(cell):
            at = np.flatnonzero(cell == c)
            pts = self.inner[int(c)]
            dist = np.linalg.norm(lifted[at][:, None, :] - pts[None, :, :], axis=2)
            d2[at, : len(pts)] = dist
            leaf[at] = dist.argmin(axis=1)
        return cell, leaf, d1, d2

    def bounds(self, a: np.ndarray) -> list[tuple[int, int, float, float]]:
        """(cell, leaf, least score, most score) of every leaf that holds rows, for one lifted query."""
        norm2 = float((a[:-1] ** 2).sum())
        d1 = np.linalg.norm(self.top - a, axis=1)
        out = []
        for j in range(len(self.top)):
            if np.isnan(self.lo1[0, j]):
                continue
            dl = max(0.0, np.nanmax(np.maximum(self.lo1[:, j] - d1, d1 - self.hi1[:, j])))
            du = float(np.nanmin(d1 + self.hi1[:, j]))
            pts = self.inner[j]
            d2 = np.linalg.norm(pts - a, axis=1)
            lo2, hi2 = self.lo2[j], self.hi2[j]
            for leaf in range(len(pts)):
                if np.isnan(lo2[0, leaf]):
                    continue
                low = max(dl, float(np.nanmax(np.maximum(lo2[:, leaf] - d2, d2 - hi2[:, leaf]))))
                high = min(du, float(np.nanmin(d2 + hi2[:, leaf])))
                slack = 1.0 + 1e-9 * (norm2 + self.m2)
                out.append((j, leaf, (norm2 + self.m2 - high * high) / 2 - slack, (norm2 + self.m2 - low * low) / 2 + slack))
        return out


def fit(rows: DataFrame, sample: int = SAMPLE) -> tuple[Tree, DataFrame]:
    """The tree, and ``rows`` with (cell, leaf, chunk) written to the shared folder."""
    m2 = rows.agg(F.max(F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x * x))).first()[0]
    if m2 is None:
        return None, None
    drawn = rows.orderBy(F.xxhash64("vec_id", F.lit("tree")), "vec_id").limit(sample).select("q").collect()
    pts = _lift(np.array([r.q for r in drawn], np.int64), float(m2), True)
    top = pts[_farthest(pts, FANOUT)]
    near = np.linalg.norm(pts[:, None, :] - top[None, :, :], axis=2).argmin(axis=1)
    inner = {j: (pts[near == j][_farthest(pts[near == j], FANOUT2)] if (near == j).any() else top[j : j + 1]) for j in range(len(top))}
    tree = Tree(float(m2), top, inner)

    def place(batches):
        for df in batches:
            q = np.array(df["q"].tolist(), np.int64).reshape(len(df), -1)
            cell, leaf, d1, d2 = tree.place(_lift(q, tree.m2, True))
            yield pd.DataFrame({"vec_id": df["vec_id"], "label": df["label"], "q": df["q"], "cell": cell, "leaf": leaf, "d1": list(d1), "d2": list(d2)})

    ship(rows.sparkSession)
    placed = written(rows.mapInPandas(place, "vec_id long, label long, q array<long>, cell long, leaf long, d1 array<double>, d2 array<double>"), "tree-rows")
    k1 = len(top)
    r1 = placed.groupBy("cell").agg(*[F.min(F.col("d1")[i]).alias(f"lo{i}") for i in range(k1)], *[F.max(F.col("d1")[i]).alias(f"hi{i}") for i in range(k1)]).collect()
    tree.lo1, tree.hi1 = np.full((k1, k1), np.nan), np.full((k1, k1), np.nan)
    for r in r1:
        tree.lo1[:, r.cell] = [r[f"lo{i}"] for i in range(k1)]
        tree.hi1[:, r.cell] = [r[f"hi{i}"] for i in range(k1)]
    r2 = placed.groupBy("cell", "leaf").agg(
        F.count(F.lit(1)).alias("n"), *[F.min(F.col("d2")[i]).alias(f"lo{i}") for i in range(FANOUT2)], *[F.max(F.col("d2")[i]).alias(f"hi{i}") for i in range(FANOUT2)]
    ).collect()
    for j, pts_j in inner.items():
        tree.lo2[j], tree.hi2[j] = np.full((len(pts_j), len(pts_j)), np.nan), np.full((len(pts_j), len(pts_j)), np.nan)
    chunks = {}
    for r in r2:
        n = len(inner[r.cell])
        tree.lo2[r.cell][:, r.leaf] = [r[f"lo{i}"] for i in range(n)]
        tree.hi2[r.cell][:, r.leaf] = [r[f"hi{i}"] for i in range(n)]
        chunks[(r.cell, r.leaf)] = max(1, -(-r.n // CHUNK))
    tree.chunks = chunks
    chunk_of = F.lit(1)
    for (c, l), n in chunks.items():
        chunk_of = F.when((F.col("cell") == c) & (F.col("leaf") == l), F.lit(n)).otherwise(chunk_of)
    leaves = placed.select("vec_id", "label", "q", "cell", "leaf", F.pmod(F.xxhash64("vec_id", "q"), chunk_of.cast("long")).alias("chunk"))
    return tree, leaves


def _routed(tree: Tree, queries: DataFrame, mode: str) -> DataFrame:
    """Each query (qkey, q, label, lo, hi, own_cell, own_leaf, bound) once per leaf it must search, with the leaf's chunks.

    ``lo`` and ``hi`` bound 100 times the score of a negative."""

    def route(batches):
        for df in batches:
            out = []
            for rec in df.itertuples(index=False):
                a = _lift(np.array([rec.q], np.int64), tree.m2, False)[0]
                for cell, leaf, least, most in tree.bounds(a):
                    if mode == "own":
                        keep = (cell, leaf) == (rec.own_cell, rec.own_leaf)
                    elif mode == "rest":
                        keep = (cell, leaf) != (rec.own_cell, rec.own_leaf) and (rec.bound is None or np.isnan(rec.bound) or most >= rec.bound)
                    else:
                        keep = rec.lo <= rec.hi and 100 * most >= rec.lo and 100 * least <= rec.hi
                    if keep:
                        for chunk in range(tree.chunks[(cell, leaf)]):
                            out.append((rec.qkey, cell, leaf, chunk))
            yield pd.DataFrame(out, columns=["qkey", "cell", "leaf", "chunk"]).astype({"cell": "int64", "leaf": "int64", "chunk": "int64"})

    ship(queries.sparkSession)
    return queries.select("qkey", "q", "own_cell", "own_leaf", "bound", "lo", "hi").mapInPandas(route, "qkey long, cell long, leaf long, chunk long")


def _search(tree: Tree, leaves: DataFrame, queries: DataFrame, mode: str, k: int) -> DataFrame:
    """Top ``k`` (qkey, vec_id, score) per query among the rows its leaves hold: exact integer scores."""
    routes = _routed(tree, queries, mode)
    per_leaf = routes.groupBy("cell", "leaf").agg(F.count(F.lit(1)).alias("nq"))
    blocks = written(
        routes.join(per_leaf, ["cell", "leaf"]).select("qkey", "cell", "leaf", "chunk", F.pmod(F.xxhash64("qkey"), F.ceil(F.col("nq") / BLOCK)).alias("block"), F.ceil(F.col("nq") / BLOCK).alias("nb")),
        "routes",
    )
    asked = blocks.select("qkey", "cell", "leaf", "chunk", "block").join(queries.select("qkey", "q", "label", "self", "lo", "hi"), "qkey")
    nb = blocks.groupBy("cell", "leaf").agg(F.max("nb").alias("n_blocks"))
    held = leaves.join(nb, ["cell", "leaf"]).select("vec_id", "label", "q", "cell", "leaf", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"))
    same = mode != "window"

    def score(rows: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or qs.empty:
            return pd.DataFrame({"qkey": [], "vec_id": [], "score": []}).astype("int64")
        r = np.array(rows["q"].tolist(), np.int64).reshape(len(rows), -1)
        ids, labels = rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
        out = []
        for rec in qs.itertuples(index=False):
            s = r @ np.array(rec.q, np.int64)
            ok = (labels == rec.label) & (ids != rec.self) if same else (labels != rec.label) & (100 * s >= rec.lo) & (100 * s <= rec.hi)
            at = np.flatnonzero(ok)
            best = at[np.lexsort((ids[at], -s[at]))][:k]
            out += [(rec.qkey, int(ids[b]), int(s[b])) for b in best]
        return pd.DataFrame(out, columns=["qkey", "vec_id", "score"]).astype("int64")

    found = held.groupBy("cell", "leaf", "chunk", "block").cogroup(asked.groupBy("cell", "leaf", "chunk", "block")).applyInPandas(
        lambda a, b: score(a, b), "qkey long, vec_id long, score long"
    )
    order = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(emb: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The hard negatives of ``emb`` (vec_id, embedding, label): rows as the module docstring says."""
    spark = emb.sparkSession
    rows = prepared(emb.select("vec_id", "embedding", "label"))
    tree, leaves = fit(rows, sample)
    if tree is None:
        return spark.createDataFrame([], OUT)
    anchors = written(
        leaves.where(F.col("vec_id") % 100 == 0).select(
            F.monotonically_increasing_id().alias("qkey"), F.col("vec_id").alias("self"), "q", "label",
            F.col("cell").alias("own_cell"), F.col("leaf").alias("own_leaf"), F.lit(None).cast("double").alias("bound"),
            F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"),
        ),
        "anchors",
    )
    own = written(_search(tree, leaves, anchors, "own", POSITIVES), "own-leaf")
    fifth = own.groupBy("qkey").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s"))
    bounded = anchors.drop("bound").join(fifth, "qkey", "left").withColumn("bound", F.when(F.col("n") >= POSITIVES, F.col("s").cast("double"))).drop("n", "s")
    rest = _search(tree, leaves, bounded, "rest", POSITIVES)
    order = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    positives = written(own.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= POSITIVES), "positives")
    pairs = positives.join(anchors.select("qkey", "self", "q", "label"), "qkey").select(
        F.xxhash64("qkey", "vec_id").alias("pkey"), "self", "q", "label", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    queries = written(
        pairs.select(
            F.col("pkey").alias("qkey"), "self", "q", "label", "positive_id", "positive_score",
            F.lit(None).cast("long").alias("own_cell"), F.lit(None).cast("long").alias("own_leaf"), F.lit(None).cast("double").alias("bound"),
            (LOW_PCT * F.col("positive_score")).alias("lo"), (HIGH_PCT * F.col("positive_score")).alias("hi"),
        ),
        "negative-queries",
    )
    negatives = _search(tree, leaves, queries, "window", NEGATIVES)
    return negatives.join(queries.select("qkey", "self", "positive_id", "positive_score"), "qkey").select(
        F.col("self").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))
