"""Heading trees: batches for detection, depth and breadcrumbs as windows, leaves, and the fix-point that merges small nodes."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.splitting import Estimate, batches, estimate, leaf_numbers, repaired_json, split_text
from ..functions.text import TABLE_ROW, token_estimate
from ..plans import settings as S
from .chunking import SLICE
from .hierarchy import HEADINGS

Detector = Callable[[list[str]], dict[int, int]]


# ---------------------------------------------------------------- windows over lines


def heading_depth(lines: DataFrame, source: str, order: str, level: str = "level") -> DataFrame:
    """Adds depth to headings (level >= 1; lower ones but -1 count as 1): the level, but at most one below the heading before.

    depth_i = min(level_i, depth_(i-1) + 1) has the closed form i + min(0, min over j <= i of (level_j - j)), i numbering the headings of
    a source; one running minimum, no state. Body lines (-1) get null.
    """
    is_heading = F.col(level) != -1
    running = Window.partitionBy(source).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.withColumn("_i", F.sum(is_heading.cast("int")).over(running))
    lowest = F.min(F.when(is_heading, F.greatest(F.col(level), F.lit(1)) - F.col("_i"))).over(running)
    return numbered.withColumn("depth", F.when(is_heading, (F.col("_i") + F.least(F.lit(0), lowest)).cast("int"))).drop("_i")


def breadcrumbs(lines: DataFrame, source: str, order: str, title: str, most_depth: int, joint: str = " > ") -> DataFrame:
    """Adds breadcrumb: the source and the titles of the headings above each line, from lines with depth (null for body).

    The heading above at depth k is the last one of depth k, for every k below the line's own depth; a body line lies below the last heading.
    """
    before = Window.partitionBy(source).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("_own", F.coalesce("depth", F.last("depth", ignorenulls=True).over(before) + 1, F.lit(1)))
    titles = [F.when(F.col("_own") > k, F.last(F.when(F.col("depth") == k, F.trim(F.col(title))), ignorenulls=True).over(before)) for k in range(1, most_depth + 1)]
    return rows.withColumn("breadcrumb", F.array_join(F.filter(F.array(F.col(source).cast("string"), *titles), lambda t: t.isNotNull() & (t != "")), joint)).drop("_own")


def _leaves(lengths: pd.Series, limit: pd.Series) -> pd.Series:
    return pd.Series([leaf_numbers(list(x), n) for x, n in zip(lengths, limit, strict=True)])


def _batches(sizes: pd.Series, limit: pd.Series) -> pd.Series:
    return pd.Series([batches(list(x), n) for x, n in zip(sizes, limit, strict=True)])


def pack_leaves(lengths: Column, limit: int = S.LEAF_TOKENS) -> Column:
    """array<int>: the leaf of each line of a section, from the lengths of its lines. Only lengths go through Arrow."""
    return F.pandas_udf(_leaves, "array<int>")(lengths, F.lit(limit))


def batch_lines(sizes: Column, limit: int = S.HEADING_BATCH_TOKENS) -> Column:
    """array<int>: the batch of each line, from token counts."""
    return F.pandas_udf(_batches, "array<int>")(sizes, F.lit(limit))


# ---------------------------------------------------------------- detection


def rule_detector(patterns: Sequence[str] = HEADINGS) -> Detector:
    """Levels by pattern: of those that fit, the finest."""
    compiled = [re.compile(p) for p in patterns]

    def detect(lines: list[str]) -> dict[int, int]:
        fits = lambda line: [k for k, p in enumerate(compiled, 1) if p.match(line)]
        return {i: max(fits(line), default=-1) for i, line in enumerate(lines)}

    return detect


HEADING_PROMPT = (
    "Give the heading level of each numbered line of a document: 1 for the highest, -1 for body text.\n"
    "Headings so far:\n{previous_headings}\n\nLines:\n{lines}\n\n"
    'Reply with JSON only: {{"items": [{{"id": <number>, "level": <level>}}]}}'
)


def reply_budget(n_lines: int) -> int:
    """Tokens that a reply about n lines may need."""
    return int((n_lines * S.HEADING_ITEM_TOKENS + S.HEADING_FRAME_TOKENS) * S.HEADING_RESERVE)


def model_detector(chat: Callable[[str, int], str], prompt: str = HEADING_PROMPT, repair: Callable[[str], str] | None = None) -> Detector:
    """Levels by a language model, batch by batch, each shown the last headings of the batches before.

    A failed call or a reply that is no JSON object makes the whole batch body text, and a line that the reply leaves out is body text.
    """

    def ask(batch: list[tuple[int, str]], known: list[str]) -> list[tuple[int, int]] | None:
        shown = "\n".join(known[-S.HEADING_CONTEXT :]) or "(none)"
        try:
            reply = chat(prompt.format(previous_headings=shown, lines="\n".join(f"[{i}] {x}" for i, x in batch)), reply_budget(len(batch)))
            found = repaired_json(reply, repair)
            return [(int(x["id"]), int(x["level"])) for x in found.get("items", [])]
        except Exception:  # any failure of the connector or of the reply's shape
            return None

    def detect(lines: list[str]) -> dict[int, int]:
        levels, known = dict.fromkeys(range(len(lines)), -1), []
        where = batches([estimate(x) for x in lines], S.HEADING_BATCH_TOKENS)
        numbered = zip(where, enumerate(lines), strict=True)
        for _, batch in itertools.groupby(numbered, key=lambda x: x[0]):
            for i, level in ask([line for _, line in batch], known) or []:
                if 0 <= i < len(lines):
                    levels[i] = level
                    if level != -1:
                        known.append(f"[{i}] {lines[i]} (level {level})")
        return levels

    return detect


# ---------------------------------------------------------------- one document's tree


@dataclass(frozen=True)
class Span:
    """What stands for a text in a tree without texts: its length and (line, piece) of all that is joined in it."""

    n: int
    items: tuple[tuple[int, int], ...]
    blank: bool = False

    def __len__(self) -> int:
        return self.n

    def then(self, other: Span) -> Span:
        return Span(self.n + 1 + other.n, self.items + other.items, self.blank and other.blank)


@dataclass
class Node:
    """A node of one document's tree; a leaf has no children."""

    content: str | Span
    children: list[Node] = field(default_factory=list)

    @property
    def is_leaf(self) -> bool:
        return not self.children

    def walk(self, path: tuple[Node, ...] = ()) -> Iterator[tuple[Node, tuple[Node, ...]]]:
        """Every node with those above it, children after their parent."""
        yield self, path
        for child in self.children:
            yield from child.walk((*path, self))


def _joined(a: str | Span, b: str | Span) -> str | Span:
    if not a:
        return b
    return a.then(b) if isinstance(a, Span) else f"{a}\n{b}"


def build(lines: Sequence[str], levels: dict[int, int], source: str) -> Node:
    """Headings below each other by depth, and the body lines of each section packed into leaves."""
    root = Node(source)
    open_nodes = [root]  # open_nodes[d] is the open node of depth d
    section: list[str] = []

    def flush() -> None:
        packed: dict[int, list[str]] = {}
        for line, leaf in zip(section, leaf_numbers([len(x) for x in section]), strict=True):
            packed.setdefault(leaf, []).append(line)
        open_nodes[-1].children += [Node("\n".join(x)) for x in packed.values()]
        section.clear()

    for i, line in enumerate(lines):
        level = levels.get(i, -1)
        if level == -1:
            section.append(line)
            continue
        flush()
        del open_nodes[max(1, level) :]
        node = Node(line)
        open_nodes[-1].children.append(node)
        open_nodes.append(node)
    flush()
    return root


def cut_leaf(text: str, count: Estimate = estimate) -> list[str]:
    """The text, in pieces if it is longer than CUT_TOKENS; rows of tables are set apart first."""
    if count(text) <= S.CUT_TOKENS:
        return [text]
    return split_text(re.sub(TABLE_ROW, r"\n\1", text), count=count) or [text]


def put_tables_in(node: Node, tables: dict[str, str], count: Estimate = estimate) -> Node:
    """Leaves with their <tab>id</tab> marks replaced (unknown ids stay) and cut if longer than CUT_TOKENS; pieces become siblings."""

    def leaves_of(leaf: Node) -> list[Node]:
        text = re.sub(r"<tab>(\w+)</tab>", lambda m: tables.get(m[1], m[0]), leaf.content)
        return [Node(p) for p in cut_leaf(text, count)]

    if node.is_leaf:
        found = leaves_of(node)
        return found[0] if len(found) == 1 else Node("", found)
    below = []
    for child in node.children:
        below += leaves_of(child) if child.is_leaf else [put_tables_in(child, tables, count)]
    return Node(node.content, below)


def merge_parents(node: Node, is_root: bool = True, count: Estimate = estimate) -> Node:
    """A node below the root whose children are leaves becomes a leaf with them if all is small enough; from the bottom up."""
    below = [merge_parents(c, False, count) for c in node.children]
    if below and not is_root and all(c.is_leaf for c in below) and count(node.content) + sum(count(c.content) for c in below) <= S.PARENT_TOKENS:
        text = node.content
        for c in below:
            text = _joined(text, c.content)
        return Node(text)
    return Node(node.content, below)


def merge_siblings(node: Node, count: Estimate = estimate) -> Node:
    """Neighbouring leaves become one while their tokens sum to less than SIBLING_TOKENS; a node with children parts them."""
    below: list[Node] = []
    for child in (merge_siblings(c, count) for c in node.children):
        if below and child.is_leaf and below[-1].is_leaf and count(below[-1].content) + count(child.content) < S.SIBLING_TOKENS:
            below[-1] = Node(_joined(below[-1].content, child.content))
        else:
            below.append(child)
    return Node(node.content, below)


def merge_headers(node: Node, is_root: bool = True, count: Estimate = estimate) -> Node:
    """A short node below the root whose only child has children goes into that child's title."""
    below = [merge_headers(c, False, count) for c in node.children]
    if not is_root and len(below) == 1 and not below[0].is_leaf and count(node.content) <= S.HEADER_TOKENS:
        return Node(_joined(node.content, below[0].content), below[0].children)
    return Node(node.content, below)


def with_leaves(node: Node) -> Node:
    """An empty leaf first wherever a node has children but no leaf among them."""
    below = [with_leaves(c) for c in node.children]
    return Node(node.content, [Node(""), *below] if below and not any(c.is_leaf for c in below) else below)


def process(root: Node, count: Estimate = estimate) -> Node:
    """Parents and siblings are merged until nothing changes, then headers, then leaves are put in."""
    while True:
        merged = merge_siblings(merge_parents(root, count=count), count)
        if merged == root:
            return with_leaves(merge_headers(merged, count=count))
        root = merged


def leaf_rows(root: Node, joint: str = " > ") -> list[tuple[str, str]]:
    """(breadcrumb, content) of the leaves that are not blank, in reading order."""
    return [(joint.join(a.content.strip() for a in above if a.content.strip()), n.content) for n, above in root.walk() if n.is_leaf and n.content.strip()]


def node_rows(root: Node, document_id: str) -> tuple[list[tuple], list[tuple]]:
    """Nodes (id, document_id, content, is_leaf, breadcrumb) and links (parent_id, child_id, order_index); ids follow from the path."""
    nodes, links = [], []

    def visit(node: Node, path: str, above: list[str]) -> str:
        own = hashlib.sha256(f"{document_id}\u0001{path}".encode()).hexdigest()[:36]
        nodes.append((own, document_id, node.content, node.is_leaf, " > ".join(above)))
        for i, child in enumerate(node.children):
            links.append((own, visit(child, f"{path}/{i}", [*above, node.content.strip()] if node.content.strip() else above), i))
        return own

    visit(root, "", [])
    return nodes, links


def document_tree(lines: Sequence[str], levels: dict[int, int], source: str, tables: dict[str, str] | None = None, count: Estimate = estimate) -> Node:
    return process(put_tables_in(build(lines, levels, source), tables or {}, count), count)


# ---------------------------------------------------------------- one source's tree, line by line

#: A node with more characters than this below it, its title included, never becomes a leaf: their tokens sum to more than PARENT_TOKENS.
_INNER = S.CHARS_PER_TOKEN * (S.PARENT_TOKENS + 1)


def settle(node: Node) -> tuple[Node, int | None]:
    """A node below the root as `process` leaves it, and the round in which it became a leaf (0: it was one; None: it never does)."""
    if node.is_leaf:
        return node, 0
    for turn in itertools.count(1):
        merged = merge_parents(node, is_root=False)
        if merged.is_leaf:
            return merged, turn
        merged = merge_siblings(merged)
        if merged == node:
            return node, None
        node = merged


class Siblings:
    """merge_siblings over the children of one node, as they come, in all rounds at once: each round holds the last leaf that it has.

    Merging goes from left to right, so what a round lets go is final in it and comes to the next round. A child that becomes a leaf
    in a later round parts its neighbours in the rounds before. Rounds in which no child becomes a leaf change nothing.
    """

    def __init__(self, out: Callable[[Span], None]):
        self.out, self.held = out, []

    def push(self, span: Span, turn: int, at: int = 1) -> None:
        """A child that is a leaf from round `turn` on, as it comes to round `at`."""
        self.held += [None] * (max(1, turn) - len(self.held))
        if at > len(self.held):
            self.out(span)
            return
        last = self.held[at - 1]
        if last is not None and turn <= at and estimate(last) + estimate(span) < S.SIBLING_TOKENS:
            self.held[at - 1] = _joined(last, span)
            return
        self.held[at - 1] = span if turn <= at else None
        if last is not None:
            self.push(last, at, at + 1)
        if turn > at:
            self.push(span, turn, at + 1)

    def flush(self) -> None:
        for at in range(1, len(self.held) + 1):
            last, self.held[at - 1] = self.held[at - 1], None
            if last is not None:
                self.push(last, at, at + 1)


@dataclass
class _Open:
    """A node that may get more children. While it can still become a leaf they are held; then `run` merges them as they come."""

    title: Span | None = None
    leaves: list[Span] = field(default_factory=list)
    bare: bool = True
    size: int = 0
    children: list[Node] = field(default_factory=list)
    run: Siblings | None = None
    path: tuple[int, ...] = ()
    below: int = 0
    inner: int = 0

    def count(self, inner: bool) -> None:
        self.below, self.inner = self.below + 1, self.inner + inner


class SourceTree:
    """build, put_tables_in (without tables), process and leaf_rows of one source for lines that come one by one, without their texts.

    Held are the open nodes, and of the topmost one that can still become a leaf all that is below it (no more than `_INNER` characters).
    A node that cannot is inner for good, as all above it are, and its children are merged and given out as they come. So memory
    does not grow with the source. `rows` gets the items of each leaf (leaf, line, piece, path of the leaf at its first item) and the inner
    nodes (line, title, whether merge_headers puts the title into its only child's).
    """

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.leaf, self.packed, self.titles = 0, None, {}
        root = _Open(bare=False)
        root.run = Siblings(lambda span: self._leaf(span, root.path))
        self.open = [root]

    def add(self, position: int, level: int, n: int, blank: bool = False, cuts: Sequence[int] | None = None, title: str | None = None) -> None:
        """cuts: the lengths of the pieces of a line that is longer than CUT_TOKENS."""
        line = Span(n, ((position, 0),), blank)
        pieces = [line] if cuts is None else [Span(c, ((position, k),), blank) for k, c in enumerate(cuts)]
        if level != -1:
            self._pack(None)
            while len(self.open) > max(1, level):
                self._close()
            self._enter()
            self.titles[position] = title
            self.open.append(_Open(line, pieces))
        elif cuts is not None:
            self._pack(None)
            self._enter()
            for piece in pieces:
                self._give(Node(piece))
        elif self.packed is not None and estimate(longer := self.packed.then(line)) <= S.LEAF_TOKENS:
            self.packed = longer
        else:
            self._pack(line)

    def end(self) -> None:
        self._pack(None)
        while len(self.open) > 1:
            self._close()
        self.open[0].run.flush()

    def _pack(self, line: Span | None) -> None:
        """The leaf that lines were packed into is whole; the next one begins with `line`."""
        done, self.packed = self.packed, line
        if done is not None:
            self._enter()
            self._give(Node(done))

    def _enter(self) -> None:
        """The deepest open node gets a child: it is no leaf of its own."""
        last = self.open[-1]
        if last.bare:
            last.bare = False
            self._grow(len(last.title))

    def _grow(self, n: int) -> None:
        for i, node in enumerate(self.open):
            if node.run is None:
                node.size += n
                if node.size > _INNER:
                    self._settle_inner(node, self.open[i - 1])

    def _settle_inner(self, node: _Open, parent: _Open) -> None:
        parent.run.flush()
        parent.count(True)
        node.path = (*parent.path, node.title.items[0][0])

        def out(span: Span) -> None:
            node.count(False)
            self._leaf(span, node.path)

        node.run = Siblings(out)
        held, node.children = node.children, []
        for child in held:
            self._place(node, child)

    def _give(self, child: Node) -> None:
        """A closed child of the deepest open node."""
        if child.is_leaf:
            self._grow(len(child.content))
        parent = self.open[-1]
        if parent.run is None:
            parent.children.append(child)
        else:
            self._place(parent, child)

    def _place(self, parent: _Open, child: Node) -> None:
        done, turn = settle(child)
        if turn is not None:
            for position, _ in done.content.items:
                self.titles.pop(position, None)
            parent.run.push(done.content, turn)
        else:
            parent.run.flush()
            parent.count(True)
            self._inner(done, parent.path)

    def _close(self) -> None:
        node = self.open.pop()
        if node.bare:
            for leaf in node.leaves:
                self._give(Node(leaf))
        elif node.run is None:
            self._give(Node(node.title, node.children))
        else:
            node.run.flush()
            self._title(node.title, node.below == node.inner == 1)

    def _inner(self, node: Node, path: tuple[int, ...]) -> None:
        path = (*path, node.content.items[0][0])
        for child in node.children:
            if child.is_leaf:
                for position, _ in child.content.items:
                    self.titles.pop(position, None)
                self._leaf(child.content, path)
            else:
                self._inner(child, path)
        self._title(node.content, len(node.children) == 1 and not node.children[0].is_leaf)

    def _title(self, title: Span, alone: bool) -> None:
        position = title.items[0][0]
        self.rows.append((None, position, None, None, self.titles.pop(position), alone and estimate(title) <= S.HEADER_TOKENS))

    def _leaf(self, span: Span, path: tuple[int, ...]) -> None:
        if not span.blank:
            self.rows += [(self.leaf, position, piece, None if k else list(path), None, None) for k, (position, piece) in enumerate(span.items)]
            self.leaf += 1


def breadcrumb(source: str, titles: Sequence[str], absorbed: Sequence[bool], joint: str = " > ") -> str:
    """The breadcrumb of leaf_rows from the titles above a leaf; an absorbed one stands in the title of the next."""
    above, title = [source], ""
    for text, merged in zip(titles, absorbed, strict=True):
        title = _joined(title, text)
        if not merged:
            above.append(title)
            title = ""
    return joint.join(a.strip() for a in above if a.strip())


# ---------------------------------------------------------------- over a DataFrame

#: Rows in an Arrow batch that is made.
_ROWS = 4096
_MARKS = "source string, position long, level int, n int, blank boolean, cuts array<int>, title string"
_PLACED = "source string, leaf long, position long, piece int, path array<long>, title string, absorbed boolean"
_MARKS_ARROW = pa.schema([("source", pa.string()), ("position", pa.int64()), ("level", pa.int32()), ("n", pa.int32()), ("blank", pa.bool_()), ("cuts", pa.list_(pa.int32())), ("title", pa.string())])
_PLACED_ARROW = pa.schema([("source", pa.string()), ("leaf", pa.int64()), ("position", pa.int64()), ("piece", pa.int32()), ("path", pa.list_(pa.int64())), ("title", pa.string()), ("absorbed", pa.bool_())])


def _batch(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _mark(position: int, level: int, line: str) -> tuple:
    cuts = [len(p) for p in cut_leaf(line)] if estimate(line) > S.CUT_TOKENS else None
    return position, level, len(line), not line.strip(), cuts, line if level != -1 else None


def mark_lines(lines: DataFrame, detector: Detector | None = None) -> DataFrame:
    """What a tree needs to know of lines (source, position, line): level, length, lengths of pieces of long ones, and titles.

    Levels by rule need one line only, so lines are not exchanged. A detector that is given gets all lines of a source at a time, as it asks
    for them; nothing else does.
    """

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                yield list(zip(*(c.to_pylist() for c in batch.slice(k, SLICE).columns), strict=True))

    def by_rule(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detect = rule_detector()
        for rows in slices(batches):
            levels = detect([line for _, _, line in rows])
            yield _batch([(source, *_mark(position, levels[i], line)) for i, (source, position, line) in enumerate(rows)], _MARKS_ARROW)

    def by_source(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = itertools.chain.from_iterable(slices(batches))
        for source, rows in itertools.groupby(every, key=lambda x: x[0]):
            rows = list(rows)
            levels = detector([line for _, _, line in rows])
            for k in range(0, len(rows), _ROWS):
                yield _batch([(source, *_mark(position, levels.get(i, -1), line)) for i, (_, position, line) in enumerate(rows[k : k + _ROWS], k)], _MARKS_ARROW)

    rows = lines.select("source", "position", "line")
    if detector is None:
        return rows.mapInArrow(by_rule, _MARKS)
    return rows.repartition("source").sortWithinPartitions("source", "position").mapInArrow(by_source, _MARKS)


def place_lines(marks: DataFrame) -> DataFrame:
    """The items of the leaves of each source's tree, and its inner nodes (leaf null), as SourceTree gives them.

    Only lengths, levels and titles of headings meet by source; a task reads them in order and holds what is open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, now = None, None
        made: list[tuple] = []
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                for own, position, level, n, blank, cuts, title in zip(*(c.to_pylist() for c in batch.slice(k, _ROWS).columns), strict=True):
                    if now is None or own != source:
                        if now is not None:
                            now.end()
                            made += [(source, *row) for row in now.rows]
                        source, now = own, SourceTree()
                    now.add(position, level, n, blank, cuts, title)
                made += [(source, *row) for row in now.rows]
                now.rows.clear()
                yield _batch(made, _PLACED_ARROW)
                made.clear()
        if now is not None:
            now.end()
            yield _batch([(source, *row) for row in now.rows], _PLACED_ARROW)

    return marks.repartition("source").sortWithinPartitions("source", "position").mapInArrow(run, _PLACED)


def cut_leaves(text: Column) -> Column:
    """array<string>: cut_leaf of each text."""
    kind = pa.list_(pa.string())

    @F.arrow_udf("array<string>")
    def cut_up(texts: pa.Array) -> pa.Array:
        made = [pa.array([cut_leaf(t) for t in texts.slice(k, SLICE).to_pylist()], kind) for k in range(0, len(texts), SLICE)]
        return pa.concat_arrays(made) if made else pa.array([], kind)

    return cut_up(text)


def joined_titles(source: Column, titles: Column) -> Column:
    """The breadcrumb of a source and array<struct<k, title, absorbed>> (null: none)."""

    @F.arrow_udf("string")
    def crumb(sources: pa.Array, above: pa.Array) -> pa.Array:
        made = []
        for k in range(0, len(sources), SLICE):
            for own, given in zip(sources.slice(k, SLICE).to_pylist(), above.slice(k, SLICE).to_pylist(), strict=True):
                made.append(breadcrumb(own, [x["title"] for x in given or []], [x["absorbed"] for x in given or []]))
        return pa.array(made, pa.string())

    return crumb(source, titles)


def paged_leaves(lines: DataFrame, placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source, leaf, titles) and (source, leaf, content) of the leaves that `place_lines` made of lines (source, position, line)."""
    inner = placed.where("leaf IS NULL").select("position", "title", "absorbed")
    above = placed.where("path IS NOT NULL").select("source", "leaf", F.posexplode("path").alias("k", "position")).join(inner, "position")
    crumbs = above.groupBy("source", "leaf").agg(F.array_sort(F.collect_list(F.struct("k", "title", "absorbed"))).alias("titles"))
    is_long = token_estimate(F.col("line")) > S.CUT_TOKENS
    texts = lines.where(~is_long).select("position", F.lit(0).alias("piece"), F.col("line").alias("_t"))
    texts = texts.unionByName(lines.where(is_long).select("position", F.posexplode(cut_leaves(F.col("line"))).alias("piece", "_t")))
    items = placed.where("leaf IS NOT NULL").select("source", "leaf", "position", "piece").join(texts, ["position", "piece"])
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("position", "piece", "_t"))), lambda x: x["_t"])
    return crumbs, items.groupBy("source", "leaf").agg(F.array_join(ordered, "\n").alias("content"))


_CHUNKS = "source string, leaf int, breadcrumb string, content string"


def chunk_documents(documents: DataFrame, detector: Detector | None = None, count: Estimate = estimate) -> DataFrame:
    """source, leaf, breadcrumb, content of documents (source, lines array<string>, tables map<string,string>).

    Trees are worked out document by document, many in each Arrow batch; a document without lines gives nothing.
    """
    detect = detector or rule_detector()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # few documents at a time are Python strings and trees
        for part in (every.iloc[k : k + SLICE] for every in parts for k in range(0, len(every), SLICE)):
            out = []
            for source, lines, tables in zip(part["source"], part["lines"], part["tables"], strict=True):
                lines = [] if lines is None else list(lines)
                if lines:
                    root = document_tree(lines, detect(lines), source, dict(tables) if tables else {}, count)
                    out += [(source, i, crumb, text) for i, (crumb, text) in enumerate(leaf_rows(root))]
            yield pd.DataFrame(out, columns=["source", "leaf", "breadcrumb", "content"])

    return documents.select("source", "lines", "tables").mapInPandas(run, _CHUNKS)


def chunk_text(breadcrumb: Column, content: Column) -> Column:
    """"[breadcrumb]\\ncontent", or the content alone."""
    return F.when(F.coalesce(breadcrumb, F.lit("")) != "", F.concat(F.lit("["), breadcrumb, F.lit("]\n"), content)).otherwise(content)
