"""A cover tree over norm-augmented vectors, searched for inner products.

A vector ``x`` gets one more coordinate, ``sqrt(m - |x|^2)``, where ``m`` is the
greatest squared length, and a query gets a zero: products stay as they are, and
all vectors have one length, so that a larger product is a smaller distance.
The tree is nested nets at scales that shrink by a factor from level to level:
a node is the centre of one of its children, its children are farther apart than
their scale, and every vector below it is within that scale of one of them. A
node keeps the radius that it really covers. With the distance of a query to its
centre this bounds every product below the node from above and from below.
"""

import heapq
import io

import numpy as np

# Scale of a level in terms of the one above; nodes with so few vectors are not split.
SHRINK, LEAF = 0.7, 24
# Nodes that a descent opens at a time.
AT_ONCE = 32
# Whole numbers below this are exact in double precision.
_EXACT = 2**53
# What rounding may take from a bound, in terms of the squared distances.
_SLACK = 1e-9


NODES = ("centre", "radius", "start", "end", "leaf")


class CoverTree:
    """Nodes are numbered with the children of one node next to each other.

    ``centre``, ``radius``, ``start`` and ``end`` describe a node; an inner node
    has the nodes from ``start`` to ``end`` as children, a leaf the ``members``
    from ``start`` to ``end``. Every vector is a member of one leaf.
    """

    def __init__(self, vectors: np.ndarray):
        """``vectors`` are whole numbers, in rows of any order."""
        self._take(vectors)
        self.augmented = self._augmented()
        self.centre, self.radius, self.start, self.end, self.leaf = [0], [0.0], [0], [0], [True]
        members, filled, top = [], 0, 0.0
        all_rows = np.arange(len(vectors))
        waiting = [(0, all_rows, self._away(all_rows, 0))] if len(vectors) else []
        while waiting:
            node, own, away = waiting.pop()
            radius = self.radius[node] = float(away.max())
            top = top or radius
            if len(own) <= LEAF or radius == 0:
                self.start[node], self.end[node] = filled, filled + len(own)
                members.append(own)
                filled += len(own)
                continue
            # the first level below whose scale is less than what the node covers
            scale = top * SHRINK ** (1 + np.floor(np.log(top / radius) / np.log(1 / SHRINK)))
            scale = scale if scale < radius else scale * SHRINK
            centres, nearest, distance = self._net(self.centre[node], own, away, scale)
            self.leaf[node] = False
            self.start[node], self.end[node] = len(self.centre), len(self.centre) + len(centres)
            order = np.argsort(nearest, kind="stable")
            cuts = np.searchsorted(nearest[order], np.arange(len(centres) + 1))
            for n, point in enumerate(centres):
                part = order[cuts[n] : cuts[n + 1]]
                waiting.append((len(self.centre), own[part], distance[part]))
                self.centre.append(point)
                for column, value in ((self.radius, 0.0), (self.start, 0), (self.end, 0), (self.leaf, True)):
                    column.append(value)
        self.members = np.concatenate(members) if members else np.zeros(0, np.int64)
        for name in NODES:
            setattr(self, name, np.array(getattr(self, name)))
        del self.augmented

    def to_bytes(self) -> bytes:
        largest = int(np.abs(self.vectors).max(initial=0))
        small = self.vectors.astype(np.min_scalar_type(-largest - 1))
        file = io.BytesIO()
        np.savez(file, vectors=small, members=self.members, **{name: getattr(self, name) for name in NODES})
        return file.getvalue()

    @classmethod
    def from_bytes(cls, content: bytes) -> "CoverTree":
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(content)) as arrays:
            for name in (*NODES, "members"):
                setattr(tree, name, arrays[name])
            tree._take(arrays["vectors"])
        return tree

    def _take(self, vectors: np.ndarray) -> None:
        self.vectors = np.ascontiguousarray(vectors, np.int64)
        squares = np.einsum("nd,nd->n", self.vectors, self.vectors)
        self.longest = int(squares.max(initial=0))
        # products are at most this large, and partial sums too
        self.exact = self.longest < _EXACT
        self.points = self.vectors.astype(np.float64)

    def _augmented(self) -> np.ndarray:
        squares = np.einsum("nd,nd->n", self.points, self.points)
        return np.column_stack([self.points, np.sqrt(np.maximum(self.longest - squares, 0))])

    def _away(self, rows: np.ndarray, centre: int) -> np.ndarray:
        gap = self.augmented[rows] - self.augmented[centre]
        return np.sqrt(np.einsum("nd,nd->n", gap, gap))

    def _net(self, first: int, own: np.ndarray, away: np.ndarray, scale: float):
        """Centres farther apart than ``scale``, the one above among them; the nearest of each vector."""
        centres, nearest, distance = [first], np.zeros(len(own), np.int64), away.copy()
        while distance[far := int(distance.argmax())] > scale:
            gap = self._away(own, own[far])
            closer = gap < distance
            # the new centre itself, whatever the rounding
            closer[far] = True
            nearest[closer], distance[closer] = len(centres), gap[closer]
            centres.append(int(own[far]))
        return centres, nearest, distance

    def below(self, leaves: np.ndarray) -> np.ndarray:
        """The members of leaves."""
        return np.concatenate([self.members[self.start[n] : self.end[n]] for n in leaves])

    def products(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        if self.exact and int(query @ query) < _EXACT:
            return (self.points[rows] @ query.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ query

    def search(self, query: np.ndarray, windows: list[tuple[int | None, int | None]], most: int, skip: int = -1):
        """For each window, the first ``most`` rows with a product in it, by product descending, then row.

        Windows are closed, an open end is None; ``skip`` is a row to leave out.
        Returns rows and products per window. Products that were computed are
        kept from one window to the next.
        """
        known = Descent(self, np.asarray(query, np.int64))
        return [known.best(low, high, most, skip) for low, high in windows]


class Descent:
    """One query on its way down a tree."""

    def __init__(self, tree: CoverTree, query: np.ndarray):
        self.tree, self.query = tree, query
        self.square = float(query.astype(np.float64) @ query)
        nodes = len(tree.centre)
        self.upper, self.lower = np.full(nodes, np.nan), np.full(nodes, np.nan)
        self.scores = np.zeros(len(tree.members), np.int64)
        self.verified = np.zeros(nodes, bool)

    def _bound(self, nodes: np.ndarray) -> None:
        """Bounds of the products below nodes, from the distances to their centres."""
        tree, whole = self.tree, self.square + self.tree.longest
        product = tree.points[tree.centre[nodes]] @ self.query.astype(np.float64)
        gap, radius = np.sqrt(np.maximum(whole - 2 * product, 0)), tree.radius[nodes]
        # rounding of a small distance is that of its square
        error = np.sqrt(_SLACK * (whole + 1)) * (gap + radius + 1)
        near, far = np.maximum(gap - radius, 0) ** 2, (gap + radius) ** 2
        self.upper[nodes] = (whole - near) / 2 + error
        self.lower[nodes] = (whole - far) / 2 - error

    def best(self, low: int | None, high: int | None, most: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
        tree = self.tree
        low_, high_ = -np.inf if low is None else low, np.inf if high is None else high
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(tree.members) or low_ > high_:
            return rows, scores
        self._bound(np.zeros(1, np.int64))
        # the node that can hold the best product comes first
        heap = [(-min(self.upper[0], high_), 0)]
        while heap:
            # at an equal product a smaller row may still win
            least = scores[-1] if len(scores) == most else -np.inf
            opened = []
            while heap and len(opened) < AT_ONCE:
                reach, node = heapq.heappop(heap)
                if -reach < least:
                    heap.clear()
                    break
                opened.append(node)
            inner = [n for n in opened if not tree.leaf[n]]
            if inner:
                children = np.concatenate([np.arange(tree.start[n], tree.end[n]) for n in inner])
                new = children[np.isnan(self.upper[children])]
                if len(new):
                    self._bound(new)
                upper, lower = self.upper[children], self.lower[children]
                # a node outside the window is skipped
                within = (upper >= max(low_, least)) & (lower <= high_)
                for reach, node in zip(np.minimum(upper[within], high_).tolist(), children[within].tolist(), strict=True):
                    heapq.heappush(heap, (-reach, node))
            leaves = np.array([n for n in opened if tree.leaf[n]], np.int64)
            if not len(leaves):
                continue
            new = leaves[~self.verified[leaves]]
            if len(new):
                own = tree.below(new)
                self.scores[own] = tree.products(own, self.query)
                self.verified[new] = True
            own = tree.below(leaves)
            found = self.scores[own]
            here = (found >= low_) & (found <= high_) & (own != skip)
            if here.any():
                rows, scores = np.concatenate([rows, own[here]]), np.concatenate([scores, found[here]])
                first = np.lexsort((rows, -scores))[:most]
                rows, scores = rows[first], scores[first]
        return rows, scores
