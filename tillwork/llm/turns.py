"""Conversations whose turns are damaged, repaired at least cost by a Viterbi search that emits edits as soon as all
surviving paths agree on them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwork.llm.common import small_batches, table

# Costs of an edit, and its letter; ties go to the letters that sort first.
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1

# What the output ends with so far: nothing, a system turn, a user turn, an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
USER_AFTER = (EMPTY, SYSTEM, ASSISTANT)
ADDED = ((EMPTY, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))  # what may follow what
ROLES = {USER: "user", ASSISTANT: "assistant"}
FOLLOWS = {"su", "ua", "au"}

BLANKS = " \t\n\r\x0b\x0c"
END_MARKS = (".", "!", "?")
NEWLINE = "\n"


class Edit:
    """A node of the tree of surviving paths. ``uses`` counts its children and the survivors that end in it."""

    __slots__ = ("parent", "letter", "role", "row", "text", "uses", "children")

    def __init__(self, parent: Edit | None, letter: str, role: str | None, row: int, text: str | None = None):
        self.parent, self.letter, self.role, self.row, self.text = parent, letter, role, row, text
        self.uses, self.children = 0, []
        if parent is not None:
            parent.uses += 1
            parent.children.append(self)

    def release(self) -> None:
        """One use less; what nothing uses any more is taken out of the tree, up to the next node in use."""
        node = self
        node.uses -= 1
        while node.uses == 0 and node.parent is not None:
            parent = node.parent
            parent.children.remove(node)
            parent.uses -= 1
            node.parent, node = None, parent


@dataclass
class Path:
    """A survivor: the cheapest edits that end in its state. ``digest`` runs over the repaired text of the path."""

    cost: int
    end: Edit
    origin: int  # the survivor of the row before that it continues
    tail: str  # letters since then
    digest: object
    empty: bool


@dataclass
class Repair:
    """Least-cost repair of one conversation, fed turn by turn in order. Nothing of a turn is kept but its edit, unless
    ``keep_texts`` asks for the texts of edits that survivors don't agree on yet.

    ``first_difference[p, q]`` holds what is left of two survivors' letters after their common beginning, cut after the
    first letter where they differ: so complete unresolved letters are compared without walking back through them."""

    keep_texts: bool = False
    paths: dict[int, Path] = field(default_factory=dict)
    first_difference: dict[tuple[int, int], tuple[str, str]] = field(default_factory=dict)
    rows: int = -1  # the row being taken

    def __post_init__(self):
        self.root = Edit(None, "", None, 0)
        self.root.uses = 2  # by this object and the first survivor
        self.paths = {EMPTY: Path(0, self.root, EMPTY, "", hashlib.sha256(), True)}
        self.first_difference = {(EMPTY, EMPTY): ("", "")}
        self._settle(self._inserted({EMPTY: (0, EMPTY, [])}))

    # A candidate is (cost, origin, steps); a step is (letter, role in the output or None, text).

    def _less(self, a, b) -> bool:
        """Whether candidate ``a`` beats ``b``: by cost, then by all its letters."""
        if a[0] != b[0]:
            return a[0] < b[0]
        left, right = self._rest(a[1], "".join(s[0] for s in a[2]), b[1], "".join(s[0] for s in b[2]))
        return left < right

    def _rest(self, p: int, tail_p: str, q: int, tail_q: str) -> tuple[str, str]:
        left, right = self.first_difference[p, q]
        if left and right:  # they differ already
            return left, right
        left, right = left + tail_p, right + tail_q
        same = 0
        while same < min(len(left), len(right)) and left[same] == right[same]:
            same += 1
        left, right = left[same:], right[same:]
        return (left[:1], right[:1]) if left and right else (left, right)

    def _offer(self, best: dict, state: int, candidate) -> bool:
        if state in best and not self._less(candidate, best[state]):
            return False
        best[state] = candidate
        return True

    def _inserted(self, best: dict) -> dict:
        """Also reaches states by inserting turns, until nothing gets better."""
        changed = True
        while changed:
            changed = False
            for before, after in ADDED:
                if before in best:
                    cost, origin, steps = best[before]
                    step = (INSERT, ROLES[after], "")
                    changed |= self._offer(best, after, (cost + INSERT_COST, origin, [*steps, step]))
        return best

    def _settle(self, best: dict) -> None:
        """Candidates become survivors; paths that nothing continues leave the tree."""
        old, new, made = self.paths, {}, {}
        for state, (cost, origin, steps) in best.items():
            source = old[origin]
            end, digest, empty = source.end, source.digest, source.empty
            for letter, role, text in steps:
                step = (end, letter, role)
                if step not in made:
                    row = self.rows + (letter == INSERT)
                    made[step] = Edit(end, letter, role, row, text if self.keep_texts else None)
                end = made[step]
                if role is not None:
                    digest = digest.copy()
                    digest.update(f"{'' if empty else NEWLINE}{role}:{text}".encode())
                    empty = False
            end.uses += 1
            new[state] = Path(cost, end, origin, "".join(s[0] for s in steps), digest, empty)
        self.first_difference = {
            (p, q): self._rest(x.origin, x.tail, y.origin, y.tail) for p, x in new.items() for q, y in new.items()
        }
        for path in old.values():
            path.end.release()
        self.paths = new

    def feed(self, role: str, text: str, must_go: bool, truncated: bool) -> list[Edit]:
        """Takes the next turn and gives back the edits that all survivors now share."""
        best: dict = {}
        extra = TRUNCATED_COST if truncated else 0
        for state, path in self.paths.items():
            self._offer(best, state, (path.cost + DELETE_COST, state, [(DELETE, None, "")]))
            if must_go:
                continue
            to = USER if state in USER_AFTER else ASSISTANT
            changed = (REROLE, ROLES[to], text)
            self._offer(best, to, (path.cost + REROLE_COST + extra, state, [changed]))
            if role[:1] == "s" and state == EMPTY:
                self._offer(best, SYSTEM, (path.cost + extra, state, [(KEEP, role, text)]))
            elif role[:1] == ROLES[to][0]:
                self._offer(best, to, (path.cost + extra, state, [(KEEP, role, text)]))
        self.rows += 1
        self._settle(self._without_hopeless(self._inserted(best)))
        return self._agreed()

    def _without_hopeless(self, best: dict) -> dict:
        """Leaves out paths that can't win any more, which else would hold on to their edits for ever. A path that ends
        in an assistant turn can go on as one that ends in a system turn does, and as an empty one does by deleting at
        most the one system turn that only the empty one may keep."""
        least = best[ASSISTANT][0]
        if SYSTEM in best and best[SYSTEM][0] > least:
            del best[SYSTEM]
        if EMPTY in best and best[EMPTY][0] > least + DELETE_COST:
            del best[EMPTY]
        return best

    def _agreed(self) -> list[Edit]:
        """Moves the root to the last edit that all survivors share; what lies before is final."""
        final = []
        while self.root.uses == 2 and self.root.children:  # this object and one child
            (child,) = self.root.children
            child.parent = None
            child.uses += 1
            self.root = child
            final.append(child)
        return final

    def finish(self) -> tuple[Path, list[Edit]]:
        """The cheapest path to a whole conversation, or to none, and its edits that were not final yet."""
        ends = {s: (p.cost, s, []) for s, p in self.paths.items() if s in (EMPTY, ASSISTANT)}
        won = min(ends)
        for state in ends:
            if self._less(ends[state], ends[won]):
                won = state
        path, rest = self.paths[won], []
        node = path.end
        while node is not self.root:
            rest.append(node)
            node = node.parent
        return path, rest[::-1]


@dataclass
class Conversation:
    """Counts faults and breaks of one conversation while its turns pass in order, and feeds its repair."""

    name: object
    keep_texts: bool = False
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    distinct: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    before: str | None = None
    steps: int = 0

    def __post_init__(self):
        self.repair = Repair(self.keep_texts)
        self.audit: list[str] = []

    def take(self, turn: int | None, role: str, text: str, again: bool) -> list[Edit]:
        if turn is not None and turn != self.last_turn:
            self.distinct += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if self.before is not None:
            self.illegal += self.before[:1] + role[:1] not in FOLLOWS
        self.before = role
        shown = text.rstrip(BLANKS)
        blank, cut = not shown, not shown.endswith(END_MARKS)
        duplicate = again and not blank
        cut = cut and not blank and not duplicate
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut
        return self.repair.feed(role, text, blank or duplicate, cut)

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.distinct


def damaged(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, turn, role, text, gone): turns damaged by a checksum of conversation and turn. Nulls of role and text
    count as one blank, as do nulls inside the checksum. Dropped turns stay as rows that are ``gone``, so that their
    conversation isn't lost. Other columns are not read."""
    blank = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), blank) for c in (conversation, turn)]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    spoiled = (
        F.when((kind == 0) | (kind == 1), F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    )
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        spoiled.alias("text"),
        (kind == 0).alias("gone"),
        F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("_times"),
    )
    return rows.withColumn("_times", F.explode("_times")).drop("_times")


def in_order(turns: DataFrame) -> DataFrame:
    """Turns by conversation and in order (turn with nulls first, then role, then text), with ``again``: whether the
    conversation holds the same role and text earlier. Both sorts use the one shuffle by conversation."""
    same = Window.partitionBy("conv_id", "role", "text", "gone").orderBy(F.col("turn").asc_nulls_first())
    placed = turns.repartition("conv_id").withColumn("again", F.row_number().over(same) > 1)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text", "again"]
    return placed.select("conv_id", "turn", "role", "text", "gone", "again").sortWithinPartitions(*order)


def walked(
    batches: Iterator[pa.RecordBatch], keep_texts: bool = False
) -> Iterator[tuple[Conversation, list[Edit], Path | None]]:
    """Passes over sorted turns: (conversation, edits that became final, the end of its cheapest path or None)."""
    now: Conversation | None = None

    def ended(conversation: Conversation) -> tuple[Conversation, list[Edit], Path]:
        path, rest = conversation.repair.finish()
        return conversation, rest, path

    for batch in batches:
        for name, turn, role, text, gone, again in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if now is None or now.name != name:
                if now is not None:
                    yield ended(now)
                now = Conversation(name, keep_texts)
            if not gone and (final := now.take(turn, role, text, again)):
                yield now, final, None
    if now is not None:
        yield ended(now)


def edits(turns: DataFrame) -> DataFrame:
    """(conv_id, step, edit, row, role, text): what to do with each turn of each conversation, in order.

    ``turns`` has conv_id, turn, role, text and gone, as from ``damaged``. ``edit`` is K (keep), R (give it ``role``),
    D (delete) or I (insert an empty turn of ``role`` before row ``row``); ``row`` counts a conversation's turns from 0.
    ``role`` and ``text`` are those of the repaired turn.
    Edits leave a task as soon as all surviving paths agree on them."""
    small_batches(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for conversation, final, _ in walked(batches, keep_texts=True):
            for edit in final:
                rows.append((conversation.name, conversation.steps, edit.letter, edit.row, edit.role, edit.text))
                conversation.steps += 1
            if len(rows) >= OUTPUT_ROWS:
                yield as_batch(rows, schema)
                rows = []
        if rows:
            yield as_batch(rows, schema)

    ordered = in_order(turns)
    schema = arrow_schema(ordered, EDIT_COLUMNS)
    return ordered.mapInArrow(run, f"conv_id {ordered.schema['conv_id'].dataType.simpleString()}, {EDIT_COLUMNS}")


def repaired(turns: DataFrame) -> DataFrame:
    """(conv_id, step, role, text): the turns of the repaired conversations, in the order of ``step``."""
    return edits(turns).where("edit <> 'D'").select("conv_id", "step", "role", "text")


def digests(turns: DataFrame) -> DataFrame:
    """A row for each conversation: gaps in its turns, faults, breaks, and the cost, letters and hash of its cheapest
    repair, which reads (system)? (user assistant)+ or is empty.

    All turns of a conversation pass one task in order, since a hash of their text can't be put together from parts;
    they are streamed from a sort that spills, and a task holds only edits that survivors don't agree on yet, a hash
    state for each survivor and one letter a turn. Conversations whose turns are all gone have zeros, no letters and
    the hash of nothing. A null conversation is one of its own; turns of equal number stand in the order of role and
    text; repeated rows are duplicates; an empty table gives no rows."""
    small_batches(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for c, final, path in walked(batches):
            c.audit.append("".join([edit.letter for edit in final]))
            if path is not None:
                counts = (c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, path.cost)
                rows.append((c.name, *counts, "".join(c.audit), path.digest.hexdigest()))
            if len(rows) >= OUTPUT_ROWS:
                yield as_batch(rows, schema)
                rows = []
        if rows:
            yield as_batch(rows, schema)

    ordered = in_order(turns)
    schema = arrow_schema(ordered, DIGEST_COLUMNS)
    return ordered.mapInArrow(run, f"conv_id {ordered.schema['conv_id'].dataType.simpleString()}, {DIGEST_COLUMNS}")


EDIT_COLUMNS = "step long, edit string, row long, role string, text string"
DIGEST_COLUMNS = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
OUTPUT_ROWS = 1000


def arrow_schema(ordered: DataFrame, columns: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {"long": pa.int64(), "string": pa.string()}
    rest = [(n, kinds[k]) for n, k in (c.split() for c in columns.split(", "))]
    return pa.schema([("conv_id", to_arrow_type(ordered.schema["conv_id"].dataType)), *rest])


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def op12_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return digests(damaged(table(spark, folder, "conversations")))
