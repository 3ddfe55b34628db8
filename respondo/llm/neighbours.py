"""The most similar vectors of every vector: a forest of random-projection trees, searched through one
priority queue a vector, with exact reranking inside the leaves.

The trees are fitted on a bounded sample (`SAMPLE` vectors, a documented bound) on the driver. A split
projects on a random direction - random signs on the groups that the sample shows, solved for the widest
margin - and cuts where few grouped vectors lie near. Where the sample runs out, or shows nothing to cut by, a node is cut through the
middle of what is known of it along one random direction a level, so leaves hold about `leaf` vectors whatever the size and shape of the
collection: a `PARTS`-th of it, but no more than `LEAF` and no fewer than `FEWEST`.

Every vector is stored in its leaf of each tree and searches with a priority queue that holds nodes of all trees: the roots first,
then the other side of every split it came by, in the order of how far the vector lies from the splits to be crossed. It
visits at most `VISITS` leaves, its own included, and none further than `SLACK`. All vectors of a leaf travel as compressed
blocks, one block a leaf and batch, so the shuffle is about `VISITS` times the stored size of the
vectors. Inside a leaf all visitors are compared with all residents by block matrix products, and the
survivors are scored again in double precision.

That finds the lists without a floor (`neighbours` at its default). A vector that its leaves part from some of its neighbours loses them, more of them
the more leaves there are, and no set of leaves holds all of a group that is larger than a leaf. So where only neighbours of some cosine are wanted, the forest
does no more than find who is linked: its blocks carry sketches of `BITS` signs in place of vectors, which makes room for `REACH` leaves of `THICKET` trees,
and its leaves say which vectors agree in `ALIKE` of them. What is linked, directly or through others, is a group; the vectors of a group come
together whole, however many they are, and are compared exactly (`Cells`). A pair is missed only if no chain of links joins it.

Exact copies are searched once: each batch sends one of them with the smallest ids of the group, each leaf compares one of them, and lists name
as many copies as can be among the nearest. The rest of the copies take over the list of the first by a narrow join at the end; a group of
copies may hold any share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.graph import join_all
from ..session import cut
from .skew import join_unique

SAMPLE = 20_000
LEAF = 6_000
PARTS = 16
FEWEST = 64
TREES = 2
VISITS = 4
SLACK = 0.03
#: Vectors scored again beside the wanted number, and how far two products of single precision may differ.
SPARE = 6
BLUR = 2e-6
#: Trees and leaves a vector visits in search of links, and within which distance of a split.
THICKET, REACH, WITHIN = 3, 12, 0.2
#: Of how many leaves a tree for links is at least; they hold `LEAF` vectors at most, as all do.
THICKET_PARTS = 64
#: Signs in a sketch, and the part in which linked ones agree; of the first `_FIRST` signs no more than `_ROUGHLY` may differ. Of two that
#: differ in as many signs as linked ones may, 70 of these are expected to differ, and 93 or more do for about six pairs in a million.
BITS, ALIKE = 512, 0.72
_FIRST, _ROUGHLY = 252, 92
#: Sketches that are compared at once, by threes, and pairs of them that are counted out at once.
_SKETCHES, _PAIRS = 3 * 256, 20_000
#: Vectors of a group compared at once; so many other blocks meet one in a cell.
BLOCK, GUESTS = 10_000, 3
#: What is known of a vector of a group that was finished in its cell.
SETTLED = ("head", "peak", "density", "delta")
#: The floor from which groups are sought; below it vectors are not told apart from unrelated ones.
FLOOR = 0.55
_ANCHORS = 128
_DRAWS = 24
_ROWS = 512
#: Vectors that are routed and packed together.
_TOGETHER = 32_768


# --- vectors -----------------------------------------------------------------------------------------


def usable(emb: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, matrix) of the vectors that take part: of the given length, finite, not all zero."""
    if isinstance(emb, pa.ChunkedArray):
        emb = emb.combine_chunks()
    sizes = emb.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dim)
    flat = emb.take(pa.array(rows)).flatten()
    x = np.array(flat.fill_null(np.nan).to_numpy(zero_copy_only=False), np.float32).reshape(len(rows), dim)
    fine = np.isfinite(x).all(1) & (x != 0).any(1)
    return rows[fine], x[fine]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64)).astype(np.float32)[:, None]


def pack(x: np.ndarray) -> bytes:
    """A block of vectors without loss: byte planes, so that like bytes stand together; two planes where
    the values fit the upper half of a float."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(x.shape[0], -1, 4)
    planes = raw[:, :, 2:] if not raw[:, :, :2].any() else raw
    return bytes([planes.shape[2]]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.transpose(2, 0, 1)).tobytes())


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], n, -1)
    raw = np.zeros((n, planes.shape[2], 4), np.uint8)
    raw[:, :, 4 - data[0] :] = planes.transpose(1, 2, 0)
    return raw.reshape(n, -1).view(np.float32)


# --- the forest --------------------------------------------------------------------------------------


class Forest:
    """Trees as flat arrays: split k projects on directions[w[k]], cuts at t[k] and has two children; a child below
    zero is leaf -1 - child."""

    def __init__(self) -> None:
        self.directions: list[np.ndarray] = []
        self.w: list[int] = []
        self.t: list[float] = []
        self.children: list[list[int]] = []
        self.roots: list[int] = []
        self.leaves = 0
        self.depth = 0

    @classmethod
    def fit(cls, sample: np.ndarray, total: int, trees: int = TREES, leaf: int | None = None, seed: int = 1) -> Forest:
        """Trees for `total` vectors from unit vectors of a sample, whose order is not kept."""
        forest = cls()
        leaf = leaf or min(LEAF, max(FEWEST, -(-total // PARTS)))
        grouped = _grouped(sample)
        for k in range(trees):
            rng = np.random.RandomState(seed + k)
            forest.roots.append(forest._grow(sample, grouped, sample.mean(0), total, leaf, rng, [], 0, 0))
        return forest

    def _grow(self, x: np.ndarray, grouped: np.ndarray, middle: np.ndarray, need: float, leaf: int, rng, shared: list[int], level: int, depth: int) -> int:
        self.depth = max(self.depth, depth)
        if need <= leaf:
            self.leaves += 1
            return -self.leaves
        share, direction = 0.0, -1
        if len(x) >= 16:
            w, t = _split(x, grouped, rng)
            share = float((x @ w > t).mean())
            if 0.05 < share < 0.95:
                direction = len(self.directions)
                self.directions.append(w)
        if direction < 0:  # nothing known to cut by: through the middle, along the direction of this level
            if level == len(shared):
                w = rng.standard_normal(len(middle)).astype(np.float32)
                shared.append(len(self.directions))
                self.directions.append(w / np.linalg.norm(w))
            direction, level = shared[level], level + 1
            w = self.directions[direction]
            t, share = float(np.median(x @ w)) if len(x) else float(middle @ w), 0.5
        at = len(self.w)
        self.w.append(direction)
        self.t.append(t)
        self.children.append([0, 0])
        above = x @ w > t
        order = np.argsort(above, kind="stable")
        x[:], grouped[:] = x[order], grouped[order]  # sorted in place: the sides are views, and the sample is in memory once
        cut_at = len(x) - int(above.sum())
        for side, some in enumerate((slice(0, cut_at), slice(cut_at, len(x)))):
            part = x[some]
            self.children[at][side] = self._grow(part, grouped[some], part.mean(0) if len(part) else middle, need * (share if side else 1 - share), leaf, rng, shared, level, depth + 1)
        return at

    def pack(self) -> Forest:
        """Lists as arrays, as they travel."""
        self.directions = np.array(self.directions, np.float32) if self.directions else np.zeros((0, 1), np.float32)
        self.w, self.t = np.array(self.w, np.int32), np.array(self.t, np.float32)
        self.children = np.array(self.children, np.int32).reshape(-1, 2)
        return self

    def route(self, x: np.ndarray, visits: int = VISITS, slack: float = SLACK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, resident) of every visit, by row. Each vector has one priority queue for all trees: the roots at no
        cost, then whatever was passed by at the largest distance to a split that has to be crossed. The
        cheapest entry is taken out and followed down to a leaf, until `visits` leaves are seen or the
        cheapest costs `slack` or more; the vector's own leaf of each tree is always seen. All vectors of a batch take their steps together."""
        if isinstance(self.t, list):
            self.pack()
        n, trees = len(x), len(self.roots)
        rounds = max(visits, trees)
        queue = np.full((n, trees + rounds * self.depth), np.inf, np.float32)
        nodes = np.zeros(queue.shape, np.int32)
        queue[:, :trees], nodes[:, :trees] = 0, self.roots
        filled = np.full(n, trees)
        rows, leaves, resident = [], [], []
        for turn in range(rounds):
            best = np.argmin(queue, axis=1)  # of equal ones the first, so roots come first
            cost = queue[np.arange(n), best]
            some = np.flatnonzero((cost < slack) | (cost == 0))
            best, cost = best[some], cost[some]
            node = nodes[some, best]
            queue[some, best] = np.inf
            inner = np.flatnonzero(node >= 0)
            while len(inner):
                inner = inner[np.argsort(node[inner], kind="stable")]
                here = node[inner]
                p = np.empty(len(inner), np.float32)
                edges = np.flatnonzero(np.r_[True, here[1:] != here[:-1], True])
                for a, b in zip(edges[:-1], edges[1:]):
                    p[a:b] = x[some[inner[a:b]]] @ self.directions[self.w[here[a]]] - self.t[here[a]]
                above = (p > 0).astype(np.int8)
                far = np.maximum(cost[inner], np.abs(p))
                push = far < slack
                who = some[inner[push]]
                queue[who, filled[who]] = far[push]
                nodes[who, filled[who]] = self.children[here[push], 1 - above[push]]
                filled[who] += 1
                node[inner] = self.children[here, above]
                inner = inner[node[inner] >= 0]
            rows.append(some)
            leaves.append(-1 - node)
            resident.append(np.full(len(some), turn < trees))
        row, leaf, lives = np.concatenate(rows), np.concatenate(leaves), np.concatenate(resident)
        order = np.argsort(row, kind="stable")
        return row[order], leaf[order], lives[order]


def _grouped(x: np.ndarray, similar: float = 0.6, against: int = 4000) -> np.ndarray:
    """Which vectors of the sample have a similar one among its first part."""
    head = x[:against]
    out = np.zeros(len(x), bool)
    for a in range(0, len(x), 500):
        near = (x[a : a + 500] @ head.T >= similar).sum(1)
        out[a : a + 500] = near > (np.arange(a, a + len(near)) < against)
    return out


def _split(x: np.ndarray, grouped: np.ndarray, rng) -> tuple[np.ndarray, float]:
    """The best of some random directions and thresholds: few grouped vectors within reach of the cut."""
    pool = np.flatnonzero(grouped) if grouped.sum() > 10 else np.arange(len(x))
    pool = x[np.sort(pool[rng.permutation(len(pool))[:4000]])]
    g = np.empty((len(pool), len(pool)), bool)
    for a in range(0, len(pool), 500):  # no more than a strip of products at once, and each pair once
        np.greater_equal(pool[a : a + 500] @ pool[a:].T, 0.6, out=g[a : a + 500, a:])
        g[a + 500 :, a : a + 500] = g[a : a + 500, a + 500 :].T
    alive = np.ones(len(pool), bool)
    anchor = np.full(len(pool), -1)
    found = 0
    for i in np.argsort(-g.sum(1), kind="stable").tolist():
        if alive[i]:
            anchor[g[i] & alive] = found
            alive &= ~g[i]
            found += 1
            if found == _ANCHORS:
                break
    order = np.argsort(anchor, kind="stable")[np.count_nonzero(anchor < 0) :]
    mass = np.bincount(anchor[order]).astype(float)
    a = np.add.reduceat(pool[order], np.r_[0, np.cumsum(mass).astype(int)[:-1]]) / mass[:, None].astype(np.float32)
    gram = a @ a.T + np.diag(0.3 / np.sqrt(mass / mass.max()))
    signs = np.zeros((len(a), _DRAWS))
    weights = mass.tolist()
    for draw in range(_DRAWS):
        balance, toss = 0.0, rng.choice([-1, 1], len(mass)).tolist()
        for i in np.argsort(-mass * rng.uniform(0.5, 1.5, len(mass))).tolist():
            sign = toss[i] if abs(balance) < weights[i] else -1 if balance > 0 else 1
            signs[i, draw] = sign
            balance += sign * weights[i]
    w = np.linalg.solve(gram, signs).T @ a
    w = (w / np.maximum(np.linalg.norm(w, axis=1), 1e-30)[:, None]).astype(np.float32)
    p = w @ x.T
    cuts = np.quantile(p, (0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65), axis=1).T
    q = p[:, grouped] if grouped.sum() > 10 else p
    loss = np.array([(np.abs(near - t[:, None]) < 0.05).mean(1) for near, t in zip(q, cuts)])
    draw, cut_at = np.unravel_index(np.argmin(loss), loss.shape)
    return w[draw], float(cuts[draw, cut_at])


# --- inside a leaf -----------------------------------------------------------------------------------


class AllPairs:
    """What all pairs of a leaf of at least the wanted cosine add up to, not only the k best of each vector:
    `mass`, the sum of the cosines, weighted by copies, and `root`, the components.

    A pair that meets in several leaves counts in that of smallest number: `places` are the leaves of every
    vector, doubled, plus one where it is a resident, filled up with -1. The smaller leaves in them are bits of a few words, and a
    pair meets elsewhere if one is at home in a leaf that the other is in."""

    def __init__(self, leaf: int, weights: np.ndarray, places: np.ndarray) -> None:
        self.leaf, self.weights, self.places = leaf, weights, places

    def start(self, x: np.ndarray, lengths: np.ndarray, order: np.ndarray, homes: int, least: float) -> None:
        self.x, self.lengths, self.homes, self.least = x, lengths, homes, least
        self.weights = self.weights[order].astype(np.float64)
        places = self.places[order]
        number, lives = places >> 1, (places & 1).astype(bool)
        known = (number >= 0) & (number < self.leaf)  # only smaller ones matter
        bit = np.searchsorted(np.unique(number[known]), number)
        words = -(-max(1, len(np.unique(number[known]))) // 64)
        self.home, self.seen = np.zeros((words, len(x)), np.uint64), np.zeros((words, len(x)), np.uint64)
        for i in range(places.shape[1]):
            rows = np.flatnonzero(known[:, i])
            mask = np.uint64(1) << (bit[rows, i] % 64).astype(np.uint64)
            self.seen[bit[rows, i] // 64, rows] |= mask
            own = lives[rows, i]
            self.home[bit[rows, i][own] // 64, rows[own]] |= mask[own]
        self.mass, self.root = np.zeros(len(x)), np.arange(len(x))

    def add(self, begin: int, s: np.ndarray, hit: np.ndarray) -> None:
        """`s` are the cosines of some rows with all residents, `hit` those that may be of the wanted size."""
        flat = np.flatnonzero(hit)
        cosines = s.ravel()[flat]
        rows, cols = np.divmod(flat, hit.shape[1])
        rows += begin
        doubtful = np.flatnonzero(cosines < self.least + 1e-5)
        if len(doubtful):
            r, c = rows[doubtful], cols[doubtful]
            exact = np.einsum("ij,ij->i", self.x[r], self.x[c], dtype=np.float64) / (self.lengths[r] * self.lengths[c])
            keep = np.ones(len(rows), bool)
            keep[doubtful] = exact >= self.least - 1e-9
            rows, cols, cosines = rows[keep], cols[keep], cosines[keep]
        join_all(self.root, rows, cols)
        here = np.ones(len(rows), bool)
        for home, seen in zip(self.home, self.seen):
            here &= ((home[rows] & seen[cols]) | (seen[rows] & home[cols])) == 0
        rows, cols, cosines = rows[here], cols[here], cosines[here]
        self.mass += np.bincount(rows, cosines * self.weights[cols], len(self.mass))
        visits = rows >= self.homes  # pairs of residents come up from both sides
        self.mass += np.bincount(cols[visits], cosines[visits] * self.weights[rows[visits]], len(self.mass))


def leaf_neighbours(x: np.ndarray, copies: list[np.ndarray], resident: np.ndarray, k: int, least: float, whole: AllPairs | None = None) -> tuple[list[int], list[np.ndarray], list[np.ndarray], list[tuple[int, int]]]:
    """(id, its neighbours' ids, their cosines) for distinct vectors with any neighbour of at least `least`: the k best
    among residents, for residents also among visitors; ties by smaller id. `x` are the vectors as stored, `copies` the smallest ids of
    each, in order, of which the first names it. With `whole`, (mass, smallest id of the component) of each besides."""
    order = np.r_[np.flatnonzero(resident), np.flatnonzero(~resident)]
    homes = int(resident.sum())
    x = x[order]
    copies = [copies[i] for i in order]
    numbers = np.array([c[0] for c in copies], np.int64)
    several = np.array([len(c) > 1 for c in copies])
    lengths = np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64))
    if whole is not None:
        whole.start(x, lengths, order, homes, least)
    a = x / lengths[:, None].astype(np.float32)
    h = a[:homes]
    want = k + SPARE
    near: list[np.ndarray] = [np.zeros(0, np.int64)] * len(a)
    floor = np.full(homes, least - 1e-5, np.float32)
    extra: dict[int, list[tuple[int, float]]] = {}
    for begin in range(0, len(a), _ROWS):
        end = min(begin + _ROWS, len(a))
        s = a[begin:end] @ h.T
        inside = min(end, homes)
        if begin < inside:
            s[np.arange(inside - begin), np.arange(begin, inside)] = -2
        hit = s >= least - 1e-5
        if whole is not None:
            whole.add(begin, s, hit)
        for r in np.flatnonzero(hit.any(1)):
            found = np.flatnonzero(hit[r])
            if len(found) > want:  # and all that single precision cannot tell from the last of them
                values = s[r, found]
                last = np.partition(values, len(found) - want)[len(found) - want]
                found = found[values >= last - BLUR]
                if begin + r < homes:
                    floor[begin + r] = last - BLUR
            near[begin + r] = found
        if end > homes:  # visitors may be neighbours of residents too
            from_row = max(0, homes - begin)
            rows, cols = np.nonzero(hit[from_row:] & (s[from_row:] >= floor))
            for r, c in zip(rows.tolist(), cols.tolist()):
                extra.setdefault(c, []).append((begin + from_row + r, s[from_row + r, c]))
    out_rows, out_near, out_cos = [], [], []
    for r in range(len(a)):
        found = near[r]
        if r in extra:
            more = extra[r]
            if len(more) > want:
                last = np.partition([e for _, e in more], len(more) - want)[len(more) - want]
                more = [(m, e) for m, e in more if e >= last - BLUR]
            found = np.r_[found, np.array([m for m, _ in more], np.int64)]
        if not len(found) and not several[r]:
            continue
        # einsum adds up each pair alike wherever it stands, so the same pair has the same cosine in every leaf
        cosines = np.einsum("ij,j->i", x[found].astype(np.float64), x[r].astype(np.float64)) / (lengths[found] * lengths[r])
        fine = cosines >= least - 1e-9
        found, cosines = found[fine], np.round(cosines[fine], 9)
        ids = numbers[found]
        if several[r] or several[found].any():
            sets = [copies[m] for m in found] + [copies[r][1:]]
            cosines = np.repeat(np.r_[cosines, 1.0], [len(c) for c in sets])
            ids = np.concatenate(sets)
        best = np.lexsort((ids, -cosines))[:k]
        if len(best):
            out_rows.append(r)
            out_near.append(ids[best])
            out_cos.append(cosines[best])
    sums: list[tuple[int, int]] = []
    if whole is not None:
        smallest = np.full(len(a), np.iinfo(np.int64).max)
        np.minimum.at(smallest, whole.root, numbers)
        sums = list(zip(np.rint(whole.mass[out_rows] * 1e6).astype(np.int64).tolist(), smallest[whole.root[out_rows]].tolist()))
    return [numbers[r] for r in out_rows], out_near, out_cos, sums


def _distinct(digests: np.ndarray, ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, heads): rows by digest and id, and where in that order another vector begins; equal digests do not
    suffice, the vectors are compared."""
    order = np.lexsort((ids, digests))
    same = digests[order][1:] == digests[order][:-1]
    at = np.flatnonzero(same)
    same[at] = (x[order[at]] == x[order[at + 1]]).all(1)
    return order, np.flatnonzero(np.r_[True, ~same])


# --- operators ---------------------------------------------------------------------------------------


def fit_forest(df: DataFrame, key: str, emb: str, trees: int = TREES, sample: int = SAMPLE, leaf: int | None = None, least_leaves: int = PARTS) -> tuple[Forest, int]:
    """(forest, dimension). The sample is drawn by key digest over the whole table; the dimension is the
    commonest length of a vector in it."""
    total = df.count()
    below = -(1 << 63) + min((1 << 64) - 1, (sample << 64) // max(1, total))  # of all 64-bit digests, whatever the total
    rows = df if total <= sample else df.where(F.xxhash64(key, F.lit(11)) < F.lit(below).cast("bigint"))
    found = rows.select(F.col(emb).cast("array<float>").alias("emb")).where(F.size("emb") > 0).limit(2 * sample).toArrow().column("emb")
    dim, x = 0, np.zeros((0, 1), np.float32)
    if len(found):
        counts = np.unique(np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in found.chunks]), return_counts=True)
        dim = int(counts[0][counts[1].argmax()])
        parts = [usable(c, dim)[1] for c in found.chunks]  # chunk by chunk, so that the sample is in memory no more than twice
        del found
        pa.default_memory_pool().release_unused()
        x = np.concatenate(parts)
        del parts
        x = unit(x)
    leaf = leaf or min(LEAF, max(FEWEST, -(-total // least_leaves)))
    return Forest.fit(x, total, trees, leaf).pack() if len(x) else Forest.fit(np.zeros((1, 1), np.float32), 1, trees, 1).pack(), dim if len(x) else 0


def neighbour_lists(df: DataFrame, key: str, emb: str, forest: Forest | None, dim: int, k: int = 15, least: float = -1.0, visits: int = VISITS, slack: float = SLACK, whole: bool = False, cells: Cells | None = None, settle: Callable | None = None) -> DataFrame:
    """(key, near array<struct<far, key>>): for every distinct usable vector - of copies that of smallest
    key - its k nearest others of at least cosine `least`, copies among them; far is (1 - cosine) in units of 1e-9.

    With `whole`, of copies only the first is in the lists, and there are also (mass, tops): the sum of the cosines with all others of at least `least`, not only the
    k nearest, weighted by copies and in units of 1e-6, and in each leaf the smallest key that is linked with the
    vector by such pairs, directly or through others.

    With `cells`, vectors meet in the cells of their group, which a column `top` names, instead of in leaves.

    With `cells` and `settle` as well, the groups that are whole in one cell are finished there: the rows are
    (key, near, mass, top, *`SETTLED`), as they come out of the cells. Those of larger groups have the first four, of each cell, for
    `merged_lists`; those of the others have the key and `SETTLED`, from `settle(copies, all pairs, keys, near, far)`, copies included."""
    shared = df.sparkSession.sparkContext.broadcast(cells or forest)
    spare = 0 if whole else min(k, (1 << 15) - 2)  # more than k + 1 copies are in nobody's list; sums need only the first
    counted = np.int32 if settle else np.int16
    names = ["leaf", "n", "ids", "copies", "resident", "digests", "vectors", *(["weights", "places"] if whole else [])]
    blocks_schema = "leaf int, n int, " + ", ".join(f"{c} binary" for c in names[2:])

    def blocks_of(ids: np.ndarray, x: np.ndarray, tops: np.ndarray | None = None) -> pa.RecordBatch:
        digests = np.fromiter((xxhash.xxh3_64_intdigest(v) for v in x), np.uint64, len(x))
        order, heads = _distinct(digests, ids, x)
        weights = np.diff(np.r_[heads, len(order)])
        place = np.arange(len(order)) - np.repeat(heads, weights)
        # what is finished in its cell names all copies there
        kept = (place <= spare) | ~np.isin(tops[order], list(cells.large)) if settle else place <= spare
        ids, x, digests = ids[order][kept], x[order[heads]], digests[order[heads]]
        starts = np.r_[0, np.cumsum(np.add.reduceat(kept, heads, dtype=np.int64))]
        row, leaf_no, resident = shared.value.route(unit(x), visits, slack) if tops is None else shared.value.route(tops[order[heads]], digests)
        if whole:
            first = np.searchsorted(row, np.arange(len(x)))
            turn = np.arange(len(row)) - first[row]
            leaf_no = leaf_no.astype(np.int32)
            places = np.full((len(x), turn.max() + 1), -1, np.int32)
            places[row, turn] = 2 * leaf_no + resident
        order = np.argsort(leaf_no, kind="stable")
        row, leaf_no, resident = row[order], leaf_no[order], resident[order]
        edges = np.flatnonzero(np.r_[True, leaf_no[1:] != leaf_no[:-1], True])
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            r = row[a:b]
            counts = starts[r + 1] - starts[r]
            taken = np.repeat(starts[r] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
            out.append((int(leaf_no[a]), b - a, ids[taken].tobytes(), counts.astype(counted).tobytes(), resident[a:b].tobytes(), digests[r].tobytes(), pack(x[r]), *((weights[r].astype(np.int64).tobytes(), places[r].tobytes()) if whole else ())))
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * (len(names) - 2)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            rows, x = usable(batch.column(1), dim)
            if len(rows):
                numbers = [batch.column(c).take(pa.array(rows)).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(0, batch.num_columns, 2)]
                held.append((numbers[0], x, *numbers[1:]))
            if sum(len(h[0]) for h in held) >= _TOGETHER:
                yield blocks_of(*map(np.concatenate, zip(*held)))
                held = []
        if held:
            yield blocks_of(*map(np.concatenate, zip(*held)))

    near_type = "array<struct<far:bigint,key:bigint>>"
    struct = pa.struct([("far", pa.int64()), ("key", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        joined = lambda c, kind: np.concatenate([np.frombuffer(v, kind) for v in table.column(c).to_pylist()])
        everyone, counts = joined("ids", np.int64), joined("copies", counted).astype(np.int64)
        resident, digests = joined("resident", bool), joined("digests", np.uint64)
        x = np.concatenate([unpack(v, n) for v, n in zip(table.column("vectors").to_pylist(), sizes)])
        starts = np.r_[0, np.cumsum(counts)]
        order, heads = _distinct(digests, everyone[starts[:-1]], x)
        ends = np.r_[heads[1:], len(order)]
        finished = settle is not None and table.column("leaf")[0].as_py() < cells.bins
        most = None if finished else spare + 1
        copies = [everyone[starts[order[a]] : starts[order[a] + 1]] if b == a + 1 else np.sort(np.concatenate([everyone[starts[i] : starts[i + 1]] for i in order[a:b]]))[:most] for a, b in zip(heads, ends)]
        pairs_ = None
        if whole:
            weights = np.add.reduceat(joined("weights", np.int64)[order], heads)
            blocks = [np.frombuffer(v, np.int32).reshape(n, -1) for v, n in zip(table.column("places").to_pylist(), sizes)]
            width = max(b.shape[1] for b in blocks)
            places = np.concatenate([np.pad(b, ((0, 0), (0, width - b.shape[1])), constant_values=-1) for b in blocks])
            pairs_ = AllPairs(table.column("leaf")[0].as_py(), weights, places[order[heads]])
        firsts = [c[:1] for c in copies] if finished else copies
        keys, near, cosines, sums = leaf_neighbours(x[order[heads]], firsts, resident[order[heads]], k, least, pairs_)
        offsets = np.cumsum([0, *map(len, near)])
        far = np.rint((1 - np.concatenate(cosines)) * 1e9).astype(np.int64) if near else np.zeros(0, np.int64)
        other = np.concatenate(near) if near else np.zeros(0, np.int64)
        if finished:
            key_, *rest = settle(copies, pairs_, np.repeat(np.array(keys, np.int64), np.diff(offsets)), other, far)
            nothing = lambda kind: pa.nulls(len(key_), kind)
            return pa.table({"key": key_, "near": nothing(pa.list_(struct)), "mass": nothing(pa.int64()), "top": nothing(pa.int64())} | dict(zip(SETTLED, rest)))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(far), pa.array(other)], fields=list(struct)))
        mass, tops = zip(*sums) if sums else ((), ())
        more = {"mass": pa.array(mass, pa.int64()), "top": pa.array(tops, pa.int64())} if whole else {}
        if settle:
            more |= {c: pa.nulls(len(keys), pa.int64()) for c in SETTLED}
        return pa.table({"key": pa.array(keys, pa.int64()), "near": lists} | more)

    vectors = df.where(F.col(key).isNotNull() & (F.size(emb) > 0)).select(F.col(key).cast("bigint").alias("key"), F.col(emb).cast("array<float>").alias("emb"), *(["top"] if cells else []))
    blocks = vectors.mapInArrow(send, blocks_schema)
    columns = [*(["mass", "top"] if whole else []), *(SETTLED if settle else [])]
    found = blocks.groupBy("leaf").applyInArrow(compare, ", ".join([f"key bigint, near {near_type}", *(f"{c} bigint" for c in columns)]))
    return found if settle else merged_lists(found, k, whole)


def merged_lists(found: DataFrame, k: int, whole: bool) -> DataFrame:
    """The lists of each vector as one: it comes from as many leaves as it lives in or visits."""
    more = [F.sum("mass").alias("mass"), F.collect_set("top").alias("tops")] if whole else []
    lists = found.groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("near"))).alias("near"), *more)
    once = F.filter("near", lambda n, i: (i == 0) | (n["key"] != F.get("near", i - 1)["key"]))
    return lists.select("key", F.slice(once, 1, k).alias("near"), *(["mass", "tops"] if whole else []))


# --- groups ------------------------------------------------------------------------------------------


def sketches(x: np.ndarray) -> np.ndarray:
    """On which side of `BITS` random planes each vector lies, as words of 64."""
    planes = np.random.RandomState(17).standard_normal((x.shape[1], BITS)).astype(np.float32)
    return np.packbits(x @ planes > 0, axis=1).view(np.uint64)


def _signs(sketch: np.ndarray) -> np.ndarray:
    """The first `_FIRST` signs as 1 and -1."""
    return np.unpackbits(sketch.view(np.uint8)[:, : -(-_FIRST // 8)], axis=1, count=_FIRST).astype(np.float32) * 2 - 1


def _roughly_alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of `a`, column of `b`): vectors of signs of which no more than `_ROUGHLY` differ.

    Three rows are multiplied as one, as the digits of a number of base 256. Half a product of signs is from -126 to 126, so the digits, 128 added,
    are the bytes of a number below 2^24; whatever is added up on the way is a multiple of a half below 2^23, so single precision is exact."""
    three = np.zeros((-(-len(a) // 3) * 3, a.shape[1]), np.float32)
    three[: len(a)] = a / 2
    packed = (three.reshape(-1, 3, a.shape[1]) * np.array([1, 256, 65536], np.float32)[:, None]).sum(1)
    numbers = packed @ b
    numbers += np.float32(128 * 65793)
    high = numbers.astype(np.uint32).view(np.uint8) >= 128 + _FIRST // 2 - _ROUGHLY
    high = high.view(np.uint32).ravel()
    place = np.flatnonzero(high != 0)
    digits = np.flatnonzero(high[place].view(np.uint8))
    place, digit = place[digits >> 2], digits & 3
    triple = place // b.shape[1]
    rows, cols = 3 * triple + digit, place - triple * b.shape[1]
    real = rows < len(a)  # a row of zeros that fills up a triple is 128
    return rows[real], cols[real]


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many of the 512 signs each sketch of `a` differs from its one of `b`."""
    counts = np.bitwise_count(np.bitwise_xor(a, b)).view(np.uint64)[:, 0]  # a byte a word
    low = np.uint64(0x00FF00FF00FF00FF)
    return ((counts & low) + (counts >> np.uint64(8) & low)) * np.uint64(0x0001000100010001) >> np.uint64(48)


def _alike(ids: np.ndarray, signs: np.ndarray, resident: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id of its component) where they differ, by sketches that agree; one of two has to be a resident."""
    order = np.lexsort((ids, *signs.T))
    heads = np.flatnonzero(np.r_[True, (signs[order][1:] != signs[order][:-1]).any(1)])
    of = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, len(order)]))
    lives = np.logical_or.reduceat(resident[order], heads)
    first = np.argsort(~lives, kind="stable")  # residents first
    s = np.ascontiguousarray(signs[order[heads]][first])
    homes, n = int(lives.sum()), len(heads)
    root = np.arange(n)
    columns = np.ascontiguousarray(_signs(s[:homes]).T)
    most = int(BITS * (1 - ALIKE))
    # no part holds both residents, which meet once, and visitors, which meet all of them
    parts = [*range(0, homes, _SKETCHES), *range(homes, n, _SKETCHES), n]
    for begin, end in zip(parts[:-1], parts[1:]):
        after = begin if begin < homes else 0
        rows, cols = _roughly_alike(_signs(s[begin:end]), columns[:, after:])
        rows, cols = rows + begin, cols + after
        while len(rows):  # part by part, so that what is joined meanwhile need not be looked at
            some, rest = slice(0, _PAIRS), slice(_PAIRS, None)
            r, c = rows[some], cols[some]
            new = root[r] != root[c]
            r, c = r[new], c[new]
            fine = _apart(s.take(r, 0), s.take(c, 0)) <= most
            join_all(root, r[fine], c[fine])
            rows, cols = rows[rest], cols[rest]
    place = np.empty(n, np.int64)
    place[first] = np.arange(n)
    mine = root[place[of]]
    numbers = ids[order]
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, mine, numbers)
    tops = least[mine]
    return numbers[tops != numbers], tops[tops != numbers]


def links(df: DataFrame, key: str, emb: str, forest: Forest, dim: int, visits: int = REACH, slack: float = WITHIN) -> DataFrame:
    """(a, b): vectors whose sketches are alike in a leaf of the forest, b the smallest key of its component there."""
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def blocks_of(ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        x = unit(x)
        signs = sketches(x)
        order = np.lexsort((ids, *signs.T))
        heads = np.flatnonzero(np.r_[True, (signs[order][1:] != signs[order][:-1]).any(1)])
        copies = np.setdiff1d(np.arange(len(order)), heads)  # only the first of equal ones goes to the leaves
        of = ids[order[heads[np.searchsorted(heads, copies, "right") - 1]]]
        out = [(-1 - int(ids[0] % 1009), ids[order[copies]].tobytes(), b"", of.tobytes())] if len(copies) else []
        own, signs = ids[order[heads]], signs[order[heads]]
        row, leaf_no, resident = shared.value.route(x[order[heads]], visits, slack)
        order = np.argsort(leaf_no, kind="stable")
        row, leaf_no, resident = row[order], leaf_no[order], resident[order]
        edges = np.flatnonzero(np.r_[True, leaf_no[1:] != leaf_no[:-1], True])
        for a, b in zip(edges[:-1], edges[1:]):
            out.append((int(leaf_no[a]), own[row[a:b]].tobytes(), resident[a:b].tobytes(), signs[row[a:b]].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int32(), *[pa.binary()] * 3])], names=["leaf", "ids", "resident", "signs"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            rows, x = usable(batch.column(1), dim)
            if len(rows):
                held.append((batch.column(0).take(pa.array(rows)).to_numpy(zero_copy_only=False).astype(np.int64), x))
            if sum(len(i) for i, _ in held) >= _TOGETHER:
                yield blocks_of(*map(np.concatenate, zip(*held)))
                held = []
        if held:
            yield blocks_of(*map(np.concatenate, zip(*held)))

    def compare(table: pa.Table) -> pa.Table:
        joined = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
        ids = joined("ids", np.int64)
        if table.column("leaf")[0].as_py() < 0:
            a, b = ids, joined("signs", np.int64)
        else:
            a, b = _alike(ids, joined("signs", np.uint64).reshape(len(ids), -1), joined("resident", bool))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    vectors = df.where(F.col(key).isNotNull() & (F.size(emb) > 0)).select(F.col(key).cast("bigint").alias("key"), F.col(emb).cast("array<float>").alias("emb"))
    return vectors.mapInArrow(send, "leaf int, ids binary, resident binary, signs binary").groupBy("leaf").applyInArrow(compare, "a bigint, b bigint")


class Cells:
    """Where the vectors of groups meet. Groups up to `block` vectors share cells of about `leaf`, a larger one is cut into blocks by the
    digests of its vectors, and each pair of blocks meets: a block is at home in a row of cells, and each of them has up to
    `GUESTS` of the blocks after it, half way round, as visitors."""

    def __init__(self, count: int, large: list[tuple[int, int]], block: int, leaf: int | None = None) -> None:
        self.bins = -(-count // (leaf or min(LEAF, max(FEWEST, -(-count // PARTS))))) or 1
        self.large, at = {}, self.bins
        for top, n in sorted(large):
            blocks = -(-n // block)
            row = -(-(blocks // 2) // GUESTS)
            self.large[top] = (at, blocks, row)
            at += blocks * row

    def route(self, tops: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, resident) of every visit, by row."""
        mixed = (tops.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        names, which = np.unique(tops, return_inverse=True)
        apart = np.isin(names, list(self.large))[which] if self.large else np.zeros(len(tops), bool)
        small = np.flatnonzero(~apart)
        rows, cells, lives = [small], [(mixed[small] % np.uint64(self.bins)).astype(np.int64)], [np.ones(len(small), bool)]
        for top in names[np.isin(names, list(self.large))].tolist() if self.large else []:
            at, n, row = self.large[top]
            some = np.flatnonzero(tops == top)
            mine = (digests[some] % np.uint64(n)).astype(np.int64)
            for c in range(row):
                rows.append(some)
                cells.append(at + mine * row + c)
                lives.append(np.ones(len(some), bool))
            for d in range(1, n // 2 + 1):
                host = (mine - d) % n
                fine = (2 * d < n) | (host < n // 2)  # blocks that face each other meet once
                rows.append(some[fine])
                cells.append((at + host * row + (d - 1) // GUESTS)[fine])
                lives.append(np.zeros(int(fine.sum()), bool))
        found, cell, resident = map(np.concatenate, (rows, cells, lives))
        order = np.argsort(found, kind="stable")
        return found[order], cell[order], resident[order]


def grouped(df: DataFrame, key: str, emb: str, trees: int | None = None, visits: int | None = None, slack: float | None = None, sample: int = SAMPLE, leaf: int | None = None, block: int = BLOCK) -> tuple[DataFrame, Cells, int]:
    """((key, emb, top) of the vectors that are linked with others, the cells where they meet, dimension)."""
    from .peaks import join_peaks

    forest, dim = fit_forest(df, key, emb, trees or THICKET, sample, leaf, THICKET_PARTS)
    found = links(df, key, emb, forest, dim, visits or REACH, WITHIN if slack is None else slack)
    groups = cut(join_peaks(found).withColumnRenamed("peak", "key"), "vector-groups")
    large = groups.groupBy("top").count().where(F.col("count") > block).collect()  # fewer than one in `block` of all rows
    cells = Cells(groups.count(), [tuple(r) for r in large], block, leaf)
    placed = df.where(F.size(emb) == dim).select(F.col(key).cast("bigint").alias("key"), F.col(emb).cast("array<float>").alias("emb")).join(groups, "key").select("key", "emb", "top")
    return placed, cells, dim


def grouped_lists(df: DataFrame, key: str, emb: str, k: int, least: float, whole: bool = False, **options) -> tuple[DataFrame, int]:
    """(what `neighbour_lists` gives, dimension) for a floor of at least `FLOOR`, out of whole groups."""
    placed, cells, dim = grouped(df, key, emb, **options)
    return cut(neighbour_lists(placed, "key", "emb", None, dim, k, least, whole=whole, cells=cells), "neighbour-lists"), dim


def copy_groups(df: DataFrame, key: str, emb: str, dim: int) -> DataFrame:
    """(key, head): the usable vectors that have exact copies, each with the smallest key of its group."""
    e = F.col(emb).cast("array<float>")
    top, low = F.array_max(e), F.array_min(e)
    # a search for NaN is false only where there is neither a NaN nor a null
    fine = (top < float("inf")) & (low > float("-inf")) & ((top != 0) | (low != 0)) & ~F.array_contains(e, F.lit(float("nan")).cast("float"))
    rows = df.where(F.col(key).isNotNull() & (F.size(emb) == dim)).where(fine).select(F.col(key).cast("bigint").alias("key"), F.xxhash64(e).alias("d1"), F.xxhash64(e, F.lit(5)).alias("d2"))
    rows = cut(rows, "vector-digests")
    groups = rows.groupBy("d1", "d2").agg(F.min("key").alias("head"), F.count("*").alias("n")).where("n > 1")
    return cut(join_unique(rows, groups, ["d1", "d2"], "n").select("key", "head"), "vector-copies")


def neighbours(df: DataFrame, key: str, emb: str, k: int = 15, least: float = -1.0, trees: int | None = None, visits: int | None = None, slack: float | None = None, sample: int = SAMPLE, leaf: int | None = None, block: int = BLOCK) -> DataFrame:
    """(key, other, cosine): the k vectors most similar to each usable vector, itself left out, equal
    cosines by smaller key; only those of cosine `least` or more.

    Null, empty, all-zero, non-finite vectors, those with null elements, of another than the table's
    usual dimension or without a key take no part. Copies are neighbours of each other with cosine 1. Keys must be unique; extra
    columns play no part; an empty table gives no rows. From a floor of `FLOOR` on, neighbours come out of whole groups."""
    if least >= FLOOR:
        lists, dim = grouped_lists(df, key, emb, k, least, trees=trees, visits=visits, slack=slack, sample=sample, leaf=leaf, block=block)
    else:
        forest, dim = fit_forest(df, key, emb, trees or TREES, sample, leaf)
        lists = cut(neighbour_lists(df, key, emb, forest, dim, k, least, visits or VISITS, SLACK if slack is None else slack), "neighbour-lists")
    # a copy has the list of the first of its group, with that one in its own place
    copies = copy_groups(df, key, emb, dim).where("key <> head")
    taken = join_unique(copies, lists.withColumnRenamed("key", "head"), ["head"])
    first = F.array(F.struct(F.lit(0).cast("bigint").alias("far"), F.col("head").alias("key")))
    theirs = F.slice(F.filter(F.array_sort(F.concat(first, "near")), lambda n: n["key"] != F.col("key")), 1, k)
    everyone = lists.select("key", "near").unionByName(taken.select("key", theirs.alias("near")))
    return everyone.select("key", F.explode("near").alias("n")).select("key", F.col("n.key").alias("other"), (1 - F.col("n.far") / 1e9).alias("cosine")).where(F.col("cosine") >= least - 1e-9)


def pairs(df: DataFrame, key: str, emb: str, k: int = 15, least: float = 0.6, **options) -> DataFrame:
    """(lo, hi): unordered pairs in which one vector at least is among the other's k nearest."""
    near = neighbours(df, key, emb, k, least, **options)
    return near.select(F.least("key", "other").alias("lo"), F.greatest("key", "other").alias("hi")).distinct()
