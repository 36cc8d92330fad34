"""An adaptive radix tree over byte keys: inner nodes of four sizes that grow, compressed paths, values at any node."""

from __future__ import annotations

from bisect import bisect_left

SMALL, MEDIUM, LARGE, FULL = 4, 16, 48, 256       # children that a layout holds


class Sorted:
    """Layout of at most `size` children: sorted edge bytes beside their children."""

    __slots__ = ("edges", "below", "size")

    def __init__(self, size: int = SMALL):
        self.edges, self.below, self.size = bytearray(), [], size

    def get(self, edge: int):
        at = bisect_left(self.edges, edge)
        return self.below[at] if at < len(self.edges) and self.edges[at] == edge else None

    def put(self, edge: int, node: Node):
        """The layout that holds the child from now on: this one, or a larger one."""
        at = bisect_left(self.edges, edge)
        if at < len(self.edges) and self.edges[at] == edge:
            self.below[at] = node
            return self
        if len(self.edges) == self.size:
            larger = Sorted(MEDIUM) if self.size == SMALL else Indexed()
            for e, n in self.items():
                larger.put(e, n)
            return larger.put(edge, node)
        self.edges.insert(at, edge)
        self.below.insert(at, node)
        return self

    def items(self):
        return zip(self.edges, self.below, strict=True)


class Indexed:
    """Layout of at most 48 children: a byte for each edge, that is the child's place and one."""

    __slots__ = ("place", "below")

    def __init__(self):
        self.place, self.below = bytearray(FULL), []

    def get(self, edge: int):
        at = self.place[edge]
        return self.below[at - 1] if at else None

    def put(self, edge: int, node: Node):
        if at := self.place[edge]:
            self.below[at - 1] = node
        elif len(self.below) == LARGE:
            full = Direct()
            for e, n in self.items():
                full.put(e, n)
            return full.put(edge, node)
        else:
            self.below.append(node)
            self.place[edge] = len(self.below)
        return self

    def items(self):
        return ((e, self.below[at - 1]) for e, at in enumerate(self.place) if at)


class Direct:
    """Layout of any children: a place for every edge."""

    __slots__ = ("below",)

    def __init__(self):
        self.below = [None] * FULL

    def get(self, edge: int):
        return self.below[edge]

    def put(self, edge: int, node: Node):
        self.below[edge] = node
        return self

    def items(self):
        return ((e, n) for e, n in enumerate(self.below) if n is not None)


class Node:
    """`path`: the bytes between the edge that leads here and this node; `values`: those of the key that ends here."""

    __slots__ = ("path", "values", "layout")

    def __init__(self, path: bytes):
        self.path, self.values, self.layout = path, [], None

    def child(self, edge: int) -> Node | None:
        return self.layout.get(edge) if self.layout is not None else None

    def attach(self, edge: int, node: Node) -> None:
        self.layout = (self.layout or Sorted()).put(edge, node)

    def items(self):
        return self.layout.items() if self.layout is not None else ()


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        node, parent, edge, at = self.root, None, 0, 0
        while True:
            path = node.path
            if not key.startswith(path, at):
                same = _common(path, key, at)
                upper = Node(path[:same])               # the path is cut where the key leaves it
                upper.attach(path[same], node)
                node.path = path[same + 1:]
                parent.attach(edge, upper)
                node, path = upper, upper.path
            at += len(path)
            if at == len(key):
                node.values.append(value)
                return
            parent, edge, node = node, key[at], node.child(key[at])
            at += 1
            if node is None:
                node = Node(key[at:])
                node.values.append(value)
                parent.attach(edge, node)
                return


def _common(path: bytes, key: bytes, at: int) -> int:
    n = min(len(path), len(key) - at)
    for i in range(n):
        if path[i] != key[at + i]:
            return i
    return n
