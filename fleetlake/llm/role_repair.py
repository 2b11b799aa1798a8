"""Repair of conversations by weighted generalised LR parsing over the grammar of roles.

The grammar of a conversation (an optional system row, then pairs of user and assistant rows, or
nothing) is turned into LR item sets.  A parse is a stack of states; the stacks of all live parses
share their tails in one graph, and parses whose stack tops are the same node are merged, keeping
the smallest (cost, audit).  A row can be kept, given another role, or deleted, and rows can be
inserted in front of it and at the end; the edits' initials are the audit.

Audits are compared without being written out.  After each row the live parses have used the same
rows and end in an edit of the last one, so none of their audits begins another: a rank per parse and
the few letters that it is extended by decide.  What a row does to the live parses depends only on
their relative costs and ranks and on the row's kind, so each such step is worked out once.

On Spark, rows are dealt by ranges of (conversation, turn), which cuts a very long conversation into
several tasks.  A conversation that lies in one task is repaired there.  Of one that does not, every
piece is parsed from each stack that it may begin with; these small tables are folded in order,
the pieces are finished with the stacks that were chosen, and only the digest or the text of the
result is put together row by row in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from fleetlake.llm import common

#: White space of rows: space and 0x09 to 0x0D.
WHITE = " \t\n\x0b\x0c\r"
#: Costs of the edits; a truncated row that is not deleted adds ``TRUNCATED``.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Text bytes and rows at which a piece of a conversation is closed.
PIECE_BYTES, PIECE_ROWS = 8 << 20, 50_000

#: Kinds of rows: whole, to be deleted (blank or repeated), truncated.
WHOLE, GONE, CUT = 0, 1, 2

#: Roles that a row can be given or inserted with, by initial.
GIVEN = {"a": "assistant", "u": "user"}

START, END = "conversation'", "$"
CONVERSATION = (
    ("conversation", ()),
    ("conversation", ("turns",)),
    ("conversation", ("s", "turns")),
    ("turns", ("pair",)),
    ("turns", ("turns", "pair")),
    ("pair", ("u", "a")),
)


class StackGraph:
    """LR states of a grammar, and the stacks that parses reach, with shared tails.

    Node 0 is the bottom; ``advance(node, terminal)`` gives the nodes after all reductions that may
    come before the terminal, and the shift; ``accepts(node)`` says whether the input may end."""

    def __init__(self, rules=CONVERSATION, terminals: str = "sua"):
        self.rules = ((START, (rules[0][0],)), *rules)
        self.terminals = terminals
        self.heads = {h for h, _ in self.rules}
        self._sets()
        self._follow()
        self.states: list[frozenset] = [self._closure({(0, 0)})]
        self.state_no = {self.states[0]: 0}
        self.goto_: dict[tuple[int, str], int | None] = {}
        self.nodes: list[tuple[int, int]] = [(0, -1)]  # (state, node below)
        self.node_no = {(0, -1): 0}
        self.moves: dict[tuple[int, str], tuple[int, ...]] = {}

    def _closure(self, items: set) -> frozenset:
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            body = self.rules[rule][1]
            if dot < len(body) and body[dot] in self.heads:
                for k, (head, _) in enumerate(self.rules):
                    if head == body[dot] and (k, 0) not in items:
                        items.add((k, 0))
                        todo.append((k, 0))
        return frozenset(items)

    def _sets(self) -> None:
        """Nullable symbols and FIRST sets."""
        self.nullable, self.first = set(), {h: set() for h in self.heads}
        changed = True
        while changed:
            before = (len(self.nullable), sum(map(len, self.first.values())))
            for head, body in self.rules:
                for x in body:
                    self.first[head] |= self.first[x] if x in self.heads else {x}
                    if x not in self.nullable:
                        break
                else:
                    self.nullable.add(head)
            changed = before != (len(self.nullable), sum(map(len, self.first.values())))

    def _follow(self) -> None:
        self.follow = {h: set() for h in self.heads}
        self.follow[START] = {END}
        changed = True
        while changed:
            before = sum(map(len, self.follow.values()))
            for head, body in self.rules:
                after = set(self.follow[head])
                for x in reversed(body):
                    if x in self.heads:
                        self.follow[x] |= after
                        after = (after if x in self.nullable else set()) | self.first[x]
                    else:
                        after = {x}
            changed = before != sum(map(len, self.follow.values()))

    def _goto(self, state: int, symbol: str) -> int | None:
        key = (state, symbol)
        if key not in self.goto_:
            kernel = {(r, d + 1) for r, d in self.states[state] if d < len(self.rules[r][1]) and self.rules[r][1][d] == symbol}
            target = None
            if kernel:
                items = self._closure(kernel)
                if items not in self.state_no:
                    self.state_no[items] = len(self.states)
                    self.states.append(items)
                target = self.state_no[items]
            self.goto_[key] = target
        return self.goto_[key]

    def _push(self, state: int, below: int) -> int:
        key = (state, below)
        if key not in self.node_no:
            self.node_no[key] = len(self.nodes)
            self.nodes.append(key)
        return self.node_no[key]

    def _reduced(self, node: int, ahead: str) -> list[int]:
        """The node and every node that reductions before ``ahead`` lead to."""
        found, todo = [node], [node]
        while todo:
            top = todo.pop()
            for rule, dot in self.states[self.nodes[top][0]]:
                head, body = self.rules[rule]
                if dot == len(body) and head != START and ahead in self.follow[head]:
                    below = top
                    for _ in body:
                        below = self.nodes[below][1]
                    target = self._goto(self.nodes[below][0], head)
                    if target is not None:
                        new = self._push(target, below)
                        if new not in found:
                            found.append(new)
                            todo.append(new)
        return found

    def advance(self, node: int, terminal: str) -> tuple[int, ...]:
        if terminal not in self.terminals or len(terminal) != 1:
            return ()
        key = (node, terminal)
        if key not in self.moves:
            shifted = ((top, self._goto(self.nodes[top][0], terminal)) for top in self._reduced(node, terminal))
            self.moves[key] = tuple(sorted({self._push(state, top) for top, state in shifted if state is not None}))
        return self.moves[key]

    def accepts(self, node: int) -> bool:
        return any((0, 1) in self.states[self.nodes[top][0]] and self.nodes[top][1] == 0 for top in self._reduced(node, END))

    def tops(self, bound: int = 1000) -> list[int]:
        """Every stack that rows can lead to; a grammar with endlessly many is refused."""
        found, todo = [0], [0]
        while todo:
            top = todo.pop()
            for t in self.terminals:
                for new in self.advance(top, t):
                    if new not in found:
                        found.append(new)
                        todo.append(new)
            if len(found) > bound:
                raise ValueError("the grammar nests: its stacks are not bounded")
        return sorted(found)


#: Live parses: ((stack top, cost above the cheapest, rank of the audit), ...) in order of tops.
Live = tuple[tuple[int, int, int], ...]


class Repairer:
    """Cheapest repairs of sequences of (initial, kind)."""

    def __init__(self, graph: StackGraph | None = None):
        self.graph = graph or StackGraph()
        self.tops = self.graph.tops()
        self.inserts = {t: self._insertions(t) for t in self.tops}
        self.steps: dict[tuple[Live, str, int], tuple[Live, int, dict]] = {}

    def _insertions(self, top: int) -> dict[int, str]:
        """top after insertions -> the fewest inserted initials that lead there (ties: the least)."""
        found, layer = {top: ""}, [top]
        while layer:
            new: dict[int, str] = {}
            for t in layer:
                for x in sorted(GIVEN):
                    for to in self.graph.advance(t, x):
                        if to not in found and (to not in new or found[t] + x < new[to]):
                            new[to] = found[t] + x
            found |= new
            layer = sorted(new)
        return found

    def start(self, top: int = 0) -> Live:
        return ((top, 0, 0),)

    def step(self, live: Live, initial: str, kind: int) -> tuple[Live, int, dict]:
        """The live parses after a row, what was added to the cheapest cost, and for each new top
        (top before, inserted initials, edit, initial of the row's new role)."""
        key = (live, initial, kind)
        if key in self.steps:
            return self.steps[key]
        best: dict[int, tuple] = {}
        extra = TRUNCATED if kind == CUT else 0
        for top, cost, rank in live:
            for between, inserted in self.inserts[top].items():
                base = cost + INSERT * len(inserted)
                edits = [(DELETE, "D", "", (between,))]
                if kind != GONE:
                    edits.append((extra, "K", initial, self.graph.advance(between, initial)))
                    edits += [(REROLE + extra, "R", x, self.graph.advance(between, x)) for x in sorted(GIVEN)]
                for price, edit, role, targets in edits:
                    for to in targets:
                        candidate = (base + price, rank, "I" * len(inserted) + edit, top, inserted, edit, role)
                        if to not in best or candidate < best[to]:
                            best[to] = candidate
        # a top that insertions reach from another for less is never needed
        kept = {t: c for t, c in best.items() if not any(t in self.inserts[o] and d[0] + INSERT * len(self.inserts[o][t]) < c[0] for o, d in best.items() if o != t)}
        ranks = {k: i for i, k in enumerate(sorted({c[1:3] for c in kept.values()}))}
        least = min(c[0] for c in kept.values())
        after = tuple((t, kept[t][0] - least, ranks[kept[t][1:3]]) for t in sorted(kept))
        self.steps[key] = (after, least, {t: c[3:] for t, c in kept.items()})
        return self.steps[key]

    def end(self, live: list[tuple[int, int, int]]) -> tuple[int, int, str]:
        """(cost, stack top, initials inserted at the end) of the cheapest accepted parse."""
        found = [
            (cost + INSERT * len(ins), rank, "I" * len(ins), top, ins)
            for top, cost, rank in live
            for to, ins in self.inserts[top].items()
            if self.graph.accepts(to)
        ]
        cost, _, _, top, ins = min(found)
        return cost, top, ins

    def trace(self, steps: list[dict], top: int) -> tuple[int, list[tuple]]:
        """(stack top at the start, (inserted, edit, role) of each row) of the parse that ends at ``top``."""
        edits = []
        for back in reversed(steps):
            top, inserted, edit, role = back[top]
            edits.append((inserted, edit, role))
        return top, edits[::-1]

    def parse(self, rows, top: int = 0) -> tuple[Live, int, list[dict]]:
        live, total, steps = self.start(top), 0, []
        for initial, kind in rows:
            live, added, back = self.step(live, initial, kind)
            total += added
            steps.append(back)
        return live, total, steps


def write_out(edits: list[tuple], rows: list[tuple], tail: str) -> tuple[str, list[str]]:
    """(audit, ``role:text`` lines) of traced edits of rows (initial, kind, role, text), and of
    insertions at the end."""
    audit, lines = [], []
    for (inserted, edit, role), row in zip(edits, rows, strict=True):
        audit.append("I" * len(inserted) + edit)
        lines += [f"{GIVEN[x]}:" for x in inserted]
        if edit == "K":
            lines.append(f"{row[2]}:{row[3]}")
        elif edit == "R":
            lines.append(f"{GIVEN[role]}:{row[3]}")
    audit.append("I" * len(tail))
    lines += [f"{GIVEN[x]}:" for x in tail]
    return "".join(audit), lines


class Piece:
    """Rows of one conversation in order, and what is counted over them."""

    def __init__(self, conv, fresh: bool):
        self.conv, self.fresh = conv, fresh
        self.rows: list[tuple] = []  # (initial, kind, role, text)
        self.size = 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.first = self.last = None  # turns

    def add(self, turn, role: str, text: str, kind: int) -> None:
        initial = role[:1]
        if self.rows and self.rows[-1][0] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.rows.append((initial, kind, role, text))
        self.size += len(text) + len(role)
        self.truncated += kind == CUT
        if turn is not None and turn != self.last:
            self.turns += 1
            self.last = turn
            if self.first is None:
                self.first = turn

    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.turns


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _results(digest: bool) -> str:
    return ", ".join(f"{c} long" for c in COUNTS) + ", audit string, " + ("repaired_sha256 string" if digest else "repaired string")


def _joined(lines: list[str], digest: bool) -> str:
    text = "\n".join(lines)
    return hashlib.sha256(text.encode("utf-8")).hexdigest() if digest else text


_REPAIRER: list[Repairer] = []


def repairer() -> Repairer:
    """One per Python worker, so that steps once worked out outlive a task."""
    if not _REPAIRER:
        _REPAIRER.append(Repairer())
    return _REPAIRER[0]


_PIECE = "seq long, initials array<string>, kinds binary, roles array<string>, texts array<string>, fold string, first_turn long, last_turn long, turns long, first_initial string, last_initial string"


def _repair_rows(conv_type, digest: bool, names: list[str], types: list):
    """Whole conversations, and the pieces of those that may go on in another task."""
    import json

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = repairer()
        task, seq = TaskContext.get().partitionId(), 0
        out: list[dict] = []
        size = 0
        piece: Piece | None = None
        previous = None

        def record(p: Piece, whole: bool) -> dict:
            nonlocal seq
            r = {"conv_id": p.conv, "whole": whole, "blank": p.blank, "duplicate": p.duplicate, "truncated": p.truncated, "illegal": p.illegal}
            kinds = [(x[0], x[1]) for x in p.rows]
            if whole:
                live, total, steps = tool.parse(kinds)
                more, top, tail = tool.end(list(live))
                _, edits = tool.trace(steps, top)
                audit, lines = write_out(edits, p.rows, tail)
                return r | {"gaps": p.gaps(), "cost": total + more, "audit": audit, "repaired": _joined(lines, digest)}
            fold = {}
            for top in [0] if p.fresh else tool.tops:
                live, total, _ = tool.parse(kinds, top)
                fold[top] = [(t, total + c, rank) for t, c, rank in live]
            r |= {"seq": (task << 32) | seq, "initials": [x[0] for x in p.rows], "kinds": bytes(x[1] for x in p.rows)}
            r |= {"roles": [x[2] for x in p.rows], "texts": [x[3] for x in p.rows], "fold": json.dumps([[k, v] for k, v in fold.items()])}
            r |= {"first_turn": p.first, "last_turn": p.last, "turns": p.turns}
            r |= {"first_initial": p.rows[0][0] if p.rows else None, "last_initial": p.rows[-1][0] if p.rows else None}
            seq += 1
            return r

        def flush() -> pa.RecordBatch:
            nonlocal out, size
            b = pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in out], t) for n, t in zip(names, types, strict=True)], names=names)
            out, size = [], 0
            return b

        opened = False
        for batch in batches:
            for conv, turn, role, text, copies, kind, late in zip(*common.batches_of(batch, "conv_id", "turn", "role", "text", "copies", "kind", "late"), strict=True):
                if piece is None or conv != piece.conv:
                    if piece is not None:
                        out.append(record(piece, piece.fresh))
                        size += piece.size
                    piece, previous = Piece(conv, opened), None
                    opened = True
                elif piece.size >= PIECE_BYTES or len(piece.rows) >= PIECE_ROWS:
                    out.append(record(piece, False))
                    size += piece.size
                    piece = Piece(conv, False)
                for _ in range(copies):
                    if kind == GONE:
                        piece.blank += 1
                        piece.add(turn, role, text, GONE)
                    elif late or previous == (turn, role, text):
                        piece.duplicate += 1
                        piece.add(turn, role, text, GONE)
                    else:
                        piece.add(turn, role, text, kind)
                    previous = (turn, role, text)
                if size >= PIECE_BYTES or len(out) >= 4096:
                    yield flush()
        if piece is not None:
            out.append(record(piece, False))
        if out:
            yield flush()

    return run


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, Iterator[dict]]]:
    """Rows that arrive sorted, as (key, row) with a mark at the first of each key."""
    last: object = _runs
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield row[key] != last, row
            last = row[key]


def _fold_pieces(names: list[str], types: list):
    """Each piece's stack tops at its start and end, and on a conversation's last piece its counts."""
    import json

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = repairer()
        seqs: list[int] = []
        backs: list[dict[int, int]] = []  # stack top after a piece -> before it
        state: dict = {}

        def finish() -> Iterator[pa.RecordBatch]:
            cost, top, tail = tool.end(state["live"])
            rows = []
            for k in range(len(seqs) - 1, -1, -1):
                before = backs[k][top]
                rows.append({"seq": seqs[k], "entry": before, "exit": top, "tail": ""})
                top = before
            rows[0] |= {"tail": tail, "cost": cost, "gaps": 0 if state["first"] is None else state["last"] - state["first"] + 1 - state["turns"], **{c: state[c] for c in ("blank", "duplicate", "truncated", "illegal")}}
            for a in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows[a : a + 4096]], t) for n, t in zip(names, types, strict=True)], names=names)

        for new, row in _runs(batches, "conv_id"):
            if new:
                if seqs:
                    yield from finish()
                seqs, backs = [], []
                state = {"live": [(0, 0, 0)], "first": None, "last": None, "turns": 0, "initial": None, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
            best: dict[int, tuple] = {}
            table = dict(json.loads(row["fold"]))
            for top, cost, rank in state["live"]:
                for to, more, inner in table[top]:
                    candidate = (cost + more, rank, inner, top)
                    if to not in best or candidate < best[to]:
                        best[to] = candidate
            ranks = {k: i for i, k in enumerate(sorted({c[1:3] for c in best.values()}))}
            state["live"] = [(t, c[0], ranks[c[1:3]]) for t, c in sorted(best.items())]
            seqs.append(row["seq"])
            backs.append({t: c[3] for t, c in best.items()})
            for c in ("blank", "duplicate", "truncated", "illegal"):
                state[c] += row[c]
            if row["first_initial"] is not None:
                if state["initial"] is not None and state["initial"] + row["first_initial"] not in ("su", "ua", "au"):
                    state["illegal"] += 1
                state["initial"] = row["last_initial"]
            if row["first_turn"] is not None:
                state["turns"] += row["turns"] - (state["last"] == row["first_turn"])
                state["first"] = row["first_turn"] if state["first"] is None else state["first"]
                state["last"] = row["last_turn"]
        if seqs:
            yield from finish()

    return run


def _finish_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and lines of each piece, parsed once more between its chosen stack tops."""
    tool = repairer()
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            rows = list(zip(row["initials"], row["kinds"], row["roles"], row["texts"], strict=True))
            _, _, steps = tool.parse([x[:2] for x in rows], row["entry"])
            _, edits = tool.trace(steps, row["exit"])
            done.append(write_out(edits, rows, row["tail"]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("at")), pa.array([a for a, _ in done], pa.string()), pa.array([lines for _, lines in done], pa.list_(pa.string()))],
            names=["at", "part", "lines"],
        )


def _join_pieces(digest: bool, names: list[str], types: list):
    """The whole audit and result of each conversation from its pieces in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit: list[str] = []
        lines: list[str] = []
        hashed, begun, last = hashlib.sha256(), False, None

        def finish() -> pa.RecordBatch:
            r = last | {"audit": "".join(audit), "repaired": hashed.hexdigest() if digest else "\n".join(lines)}
            return pa.RecordBatch.from_arrays([pa.array([r[n]], t) for n, t in zip(names, types, strict=True)], names=names)

        for new, row in _runs(batches, "conv_id"):
            if new:
                if last is not None:
                    yield finish()
                audit, lines, hashed, begun = [], [], hashlib.sha256(), False
            last = row
            audit.append(row["part"])
            if digest:
                for line in row["lines"]:
                    hashed.update((("\n" if begun else "") + line).encode("utf-8"))
                    begun = True
            else:
                lines += row["lines"]
        if last is not None:
            yield finish()

    return run


def crc_of_place() -> Column:
    """crc32 of ``conv_id:turn`` as text; a null is one space."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    return F.crc32(F.encode(F.concat(parts[0], F.lit(":"), parts[1]), "UTF-8"))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after the damage that each row's place decides: of 20
    places one is dropped (copies 0), one loses its text, one its ``[.!?]``, one is repeated
    (copies 2) and one gets the role user.  A null role or text is one space."""
    what = crc_of_place() % 20
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(what == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(what == 1, F.lit("")).when(what == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(what == 0, 0).when(what == 3, 2).otherwise(1).alias("copies"),
    )


def repair_conversations(rows: DataFrame, digest: bool = False) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text, and optionally copies: how often a
    row stands in its conversation, 0 for one that only names it):

    gaps (turns missing between the first and the last), blank, duplicate, truncated (rows by their
    first fault), illegal (neighbours whose role initials are not su, ua or au), cost and audit of
    the cheapest repair (ties: the least audit), repaired (``role:text`` lines; with ``digest``
    repaired_sha256).

    Rows are taken by turn, nulls first, then role and text.  Null roles and texts are one space;
    null conv_ids are one conversation; repeated rows are duplicates; a conversation without rows has
    zeros, an empty audit and an empty result; other columns are ignored, names of results included;
    an empty table gives none.  The text of a conversation that many tasks share is hashed in order
    by one of them, a stream that holds one piece at a time; nothing else of it comes together.
    """
    spark = rows.sparkSession
    common.configure(spark)
    copies = F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)
    base = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        copies.alias("copies"),
    )
    end = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    kind = F.when(end == "", GONE).when(end.isin(".", "!", "?"), WHOLE).otherwise(CUT)
    key = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    base = base.withColumn("kind", kind).withColumn("key", F.when((F.col("kind") != GONE) & (F.col("copies") > 0), key))
    # where the same role and text stand more than once: one row for each, whatever their number
    again = (
        base.where("key is not null")
        .groupBy("conv_id", "key")
        .agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("turn")).alias("first"))
        .where("times > 1")
        .select(F.col("conv_id").alias("again_conv"), F.col("key").alias("again_key"), "first")
    )
    found = base.join(again, F.col("conv_id").eqNullSafe(F.col("again_conv")) & (F.col("key") == F.col("again_key")), "left")
    ordered = (
        found.select("conv_id", "turn", "role", "text", "copies", "kind", F.coalesce(F.struct("turn") > F.col("first"), F.lit(False)).alias("late"))
        .repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    conv = rows.schema["conv_id"].dataType
    schema = f"conv_id {conv.simpleString()}, whole boolean, {_results(False)}, {_PIECE}"
    pieces = common.written(ordered.mapInArrow(_repair_rows(conv, digest, *_columns(schema)), schema), "conversation-pieces")
    names = ["conv_id", *COUNTS, "audit", "repaired"]
    open_ = pieces.where("not whole")
    # keys are dealt to tasks; a conversation's rows here are one for each of its pieces
    small = open_.select("conv_id", "seq", "fold", "blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "turns", "first_initial", "last_initial")
    plan = "seq long, entry int, exit int, tail string, " + ", ".join(f"{c} long" for c in COUNTS)
    chosen = small.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(_fold_pieces(*_columns(plan)), plan)
    at = F.struct("conv_id", "seq", *[F.col(f"_{c}").alias(c) for c in COUNTS]).alias("at")
    chosen = chosen.select(F.col("seq").alias("_seq"), "entry", "exit", "tail", *[F.col(c).alias(f"_{c}") for c in COUNTS])
    payload = open_.select("conv_id", "seq", "initials", "kinds", "roles", "texts").join(chosen, F.col("seq") == F.col("_seq")).select(at, "initials", "kinds", "roles", "texts", "entry", "exit", "tail")
    parts = payload.mapInArrow(_finish_pieces, f"at {payload.schema['at'].dataType.simpleString()}, part string, lines array<string>").select("at.*", "part", "lines")
    whole = f"conv_id {conv.simpleString()}, {_results(False)}"
    joined = parts.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(_join_pieces(digest, *_columns(whole)), whole)
    out = pieces.where("whole").select(*names).unionByName(joined.select(*names))
    return out.withColumnRenamed("repaired", "repaired_sha256") if digest else out


def _columns(ddl: str) -> tuple[list[str], list]:
    """Names and Arrow types of a schema."""
    fields: list[StructField] = StructType.fromDDL(ddl).fields
    return [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]
