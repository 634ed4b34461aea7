"""Conversation structure repair by scalar big-integer weights.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. The
cheapest edits that make it so are a shortest path through a small graph: a row
leads from one of four states (nothing yet, after the system row, after a user,
after an assistant) to another. A path's weight is one integer. Its high digits
are the cost; below them every row has a slot of three octal digits for the audit
letters (at most two inserts, then the row's own edit; D, I, K, R are 1 to 4), and
zeros fill the end of a slot. An edge's integer already stands at its place, so
weights are added, and the smaller integer is the cheaper path or, of equal cost,
the one whose audit comes first in ASCII. More than two inserts in a row only
repeat a state, so slots of three digits hold every cheapest path.

Paths through stretches of rows combine like matrices over (min, +). Rows are
range-partitioned in their order; a task folds each conversation's rows of its
slice into one matrix, and the matrices of a conversation, one for each slice,
give the audit. A conversation of any length is thus spread over tasks; only its
audit (which is one value of the result) and its ordered output meet in one task,
which streams the rows and holds none.

Rows are taken by turn (null first), then role, then the SHA-256 of the text;
texts with equal SHA-256 count as equal. A null role or text is one space. A null
conv_id is a conversation of its own. Roles other than those beginning with s, u
or a can only be rewritten or deleted. Rows that repeat whole are counted before
the shuffle and handled as a power of a matrix. An empty table gives empty
results; other columns are not looked at.
"""

import hashlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.relations import same_keys
from tradeloom.functions.staging import settle
from tradeloom.llm.text import in_arrow

START, SYSTEM, USER, ASSISTANT = range(4)
#: State after one inserted row.
INSERTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
SLOT = 9
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = str.maketrans("1234", "DIKR", "0")
#: Rows of one kind from which on a matrix power is used, and rows of a block.
BLOCK = 64
WHITE = r"\x20\x09-\x0D"
EMPTY = hashlib.sha256(b"").hexdigest()
ORDER = ["turn", "role", "digest"]


# --- the graph ---------------------------------------------------------------

def slot(letters: str) -> int:
    """Three octal digits, zeros at the end."""
    return sum(DIGIT[c] << 3 * (2 - k) for k, c in enumerate(letters))


def _edges(initial: str, must_go: bool, truncated: bool) -> dict:
    """(from, to) -> (cost, slot) of the least edge of one row."""
    found: dict = {}

    def offer(begin, end, cost, letters):
        weight = (cost, slot(letters))
        found[begin, end] = min(found.get((begin, end), weight), weight)

    for begin in range(4):
        at = begin
        for inserts in range(3):
            cost, letters = 2 * inserts, "I" * inserts
            offer(begin, at, cost + 3, letters + "D")
            if not must_go:
                turn = INSERTED[at]
                if initial == "s" and at == START:
                    offer(begin, SYSTEM, cost + truncated, letters + "K")
                if initial == ("a" if turn == ASSISTANT else "u"):
                    offer(begin, turn, cost + truncated, letters + "K")
                offer(begin, turn, cost + 2 + truncated, letters + "R")
            at = INSERTED[at]
    return found


#: Edges of every kind of row: initial, must go, truncated.
EDGES = {(i, m, t): _edges(i, m, t) for i in "sua?" for m in (False, True) for t in (False, True)}
#: Closing inserts by the state they start from.
CLOSING = {START: (0, 0), ASSISTANT: (0, 0), USER: (2, slot("I")), SYSTEM: (4, slot("II"))}


@lru_cache(maxsize=20_000)
def block(kinds: tuple, starts: tuple = (0, 1, 2, 3)) -> tuple:
    """(rows, {(from, to): least weight}) of a stretch of rows: a forward pass from every start."""
    n = len(kinds)
    scale, out = SLOT * n, {}
    for start in starts:
        best = {start: 0}
        for k, kind in enumerate(kinds):
            shift, new = SLOT * (n - 1 - k), {}
            for (begin, end), (cost, letters) in EDGES[kind].items():
                if begin in best:
                    weight = best[begin] + (cost << scale) + (letters << shift)
                    if end not in new or weight < new[end]:
                        new[end] = weight
            best = new
        out.update({(start, end): weight for end, weight in best.items()})
    return n, out


def combined(a: tuple, b: tuple) -> tuple:
    """Least weights through stretch ``a`` and then ``b``."""
    (n, left), (m, right) = a, b
    low, high, out = SLOT * m, SLOT * (n + m), {}
    raised = {key: ((w >> low) << high) + (w & ((1 << low) - 1)) for key, w in right.items()}
    for (begin, middle), w in left.items():
        w <<= low
        for end in range(4):
            if (middle, end) in raised:
                weight = w + raised[middle, end]
                if (begin, end) not in out or weight < out[begin, end]:
                    out[begin, end] = weight
    return n + m, out


def power(one: tuple, n: int) -> tuple:
    """Weights through ``n`` equal stretches, by squaring."""
    out = None
    while n:
        if n & 1:
            out = one if out is None else combined(out, one)
        n >>= 1
        if n:
            one = combined(one, one)
    return out


class Stretch:
    """Folds stretches in order; sizes on the stack fall, so each is combined few times."""

    def __init__(self):
        self.kinds, self.stack = [], []

    def add(self, kind: tuple, copies: int = 1) -> None:
        if copies <= BLOCK:
            for _ in range(copies):
                self.kinds.append(kind)
                if len(self.kinds) == BLOCK:
                    self.flush()
        else:
            self.flush()
            self.push(power(block((kind,)), copies))

    def flush(self) -> None:
        if self.kinds:
            self.push(block(tuple(self.kinds)))
            self.kinds = []

    def push(self, part: tuple) -> None:
        while self.stack and self.stack[-1][0] <= part[0]:
            part = combined(self.stack.pop(), part)
        self.stack.append(part)

    def whole(self) -> tuple:
        """Matrix of all that was added, in order."""
        self.flush()
        out = self.stack[-1]
        for part in reversed(self.stack[:-1]):
            out = combined(part, out)
        return out


def least(total: tuple) -> tuple[int, str]:
    """Cost and octal slots of the cheapest path from the start, closing slot included."""
    n, weights = total
    ends = []
    for (begin, end), w in weights.items():
        if begin == START:
            cost, letters = CLOSING[end]
            scale = SLOT * n
            ends.append((((w >> scale) + cost) << (scale + SLOT)) + ((w & ((1 << scale) - 1)) << SLOT) + letters)
    weight, scale = min(ends), SLOT * (n + 1)
    return weight >> scale, format(weight & ((1 << scale) - 1), "o").zfill(3 * (n + 1))


# --- rows ----------------------------------------------------------------------

def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text; a null role or text becomes one space."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long"),
        _spaced("role").alias("role"), _spaced("text").alias("text"),
    )


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of a conversations table with faults put in by a hash of conversation and turn.

    Of 20 remainders, 0 drops the row, 1 empties the text, 2 takes ``.!?`` out of it,
    3 repeats the row and 4 makes its role user.
    """
    fault = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.filter("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def skeleton(turns: DataFrame) -> DataFrame:
    """Rows without their texts: conv, turn, role, digest, n copies, blank, open, first."""
    text = F.col("text")
    rows = turns.select(
        "conv", "turn", "role", F.sha2(text.cast("binary"), 256).alias("digest"),
        (~text.rlike(f"[^{WHITE}]")).alias("blank"), (~text.rlike(rf"[.!?][{WHITE}]*\z")).alias("open"),
    )
    rows = settle(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), "repair-rows")
    seen = rows.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(F.struct("turn")).alias("seen")
    )
    both = rows.join(seen, same_keys({"conv": "c", "role": "r", "digest": "d"}))
    return both.select(*rows.columns, F.col("turn").eqNullSafe(F.col("seen.turn")).alias("first"))


PART = (
    "conv long, at long, turn long, role string, digest string, n long, weights array<struct<begin:int,end:int,weight:binary>>,"
    " head string, tail string, least_turn long, last_turn long, n_turns long, blank long, duplicate long, truncated long, illegal long"
)


def parts(rows: DataFrame) -> DataFrame:
    """One row for each conversation and slice of the global order: its matrix and counts."""
    keys = [F.col(c).asc_nulls_first() for c in ("conv", *ORDER)]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    columns = ["conv", "at", *ORDER, "n", "blank", "open", "first"]

    def folded(batches):
        now = None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(len(columns)))):
                if now is None or now.conv != row[0]:
                    if now:
                        yield now.row()
                    now = _Part(row)
                now.add(row)
        if now:
            yield now.row()

    return in_arrow(placed.select(*columns), folded, PART)


LEGAL = ("su", "ua", "au")


class _Part:
    """What a slice holds of one conversation."""

    def __init__(self, row: tuple):
        self.conv, self.key = row[0], row[1:5]
        self.path, self.n, self.head, self.tail = Stretch(), 0, row[3][:1], None
        self.least_turn = self.last_turn = None
        self.counts = {"turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def add(self, row: tuple) -> None:
        _, _, turn, role, _, n, blank, open_, first = row
        initial, count = role[:1], self.counts
        if turn is not None and turn != self.last_turn:
            count["turns"] += 1
            self.least_turn = turn if self.least_turn is None else self.least_turn
            self.last_turn = turn
        if self.tail is not None and self.tail + initial not in LEGAL:
            count["illegal"] += 1
        if initial + initial not in LEGAL:
            count["illegal"] += n - 1
        fresh_ = first and not blank
        truncated = fresh_ and open_
        count["blank"] += n if blank else 0
        count["duplicate"] += 0 if blank else n - first
        count["truncated"] += truncated
        kind = initial if initial in ("s", "u", "a") else "?"
        self.path.add((kind, not fresh_, truncated))
        if n > 1:
            self.path.add((kind, True, False), n - 1)
        self.tail, self.n = initial, self.n + n

    def row(self) -> tuple:
        _, weights = self.path.whole()
        packed = [(b, e, w.to_bytes((w.bit_length() + 7) // 8, "big")) for (b, e), w in weights.items()]
        at, *key = self.key
        return (self.conv, at, *key, self.n, packed, self.head, self.tail, self.least_turn, self.last_turn, *self.counts.values())


FOUND = (
    "conv long, turn long, role string, digest string, slots string, n_rows long, gaps long, blank long, duplicate long,"
    " truncated long, illegal long, cost long, audit string"
)


def decide(folded: DataFrame) -> DataFrame:
    """For each conversation one row of results (role null), and one for each part with the slots of its rows."""
    names = [c.split()[0] for c in PART.split(", ")]
    sorted_ = folded.select(*names).repartition("conv").sortWithinPartitions("conv", "at")

    def rows(batches):
        held: list = []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(len(names)))):
                row = dict(zip(names, row))
                if held and held[0]["conv"] != row["conv"]:
                    yield from _decided(held)
                    held = []
                held.append(row)
        if held:
            yield from _decided(held)

    return in_arrow(sorted_, rows, FOUND, flush=2000)


def _decided(held: list):
    path = Stretch()
    for part in held:
        weights = {(w["begin"], w["end"]): int.from_bytes(w["weight"], "big") for w in part["weights"]}
        path.push((part["n"], weights))
    cost, slots = least(path.whole())
    n, count = sum(p["n"] for p in held), {k: sum(p[k] for p in held) for k in ("blank", "duplicate", "truncated", "illegal")}
    count["illegal"] += sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(held, held[1:]))
    turned = [p for p in held if p["n_turns"]]
    gaps = 0
    if turned:
        distinct = sum(p["n_turns"] for p in turned) - sum(a["last_turn"] == b["least_turn"] for a, b in zip(turned, turned[1:]))
        gaps = turned[-1]["last_turn"] - turned[0]["least_turn"] + 1 - distinct
    yield (held[0]["conv"], None, None, None, slots[3 * n :], n, gaps, *count.values(), cost, slots.translate(LETTERS))
    at = 0
    for part in held:
        mine = slots[3 * at : 3 * (at + part["n"])]
        yield (part["conv"], part["turn"], part["role"], part["digest"], mine, *[None] * 8)
        at += part["n"]


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reports, repaired turns) of conversations (conv_id, turn, role, text).

    reports: conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit.
    turns: conv_id, place, edit, turn, role, text, in each conversation's order; an inserted
    row has no turn. Turns come partitioned by conversation and sorted by place.
    """
    turns = turns_of(conversations)
    found = settle(decide(settle(parts(skeleton(turns)), "repair-parts")), "repair-found")
    reports = found.filter("role is null").select(F.col("conv").alias("conv_id"), *[c.split()[0] for c in FOUND.split(", ")[5:]])
    texts = turns.select("conv", "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "text", F.lit(None).cast("string").alias("slots"))
    marks = found.select("conv", *ORDER, F.lit(None).cast("string").alias("text"), "slots")
    keys = [F.col(c).asc_nulls_first() for c in ("conv", *ORDER, "text")]
    sorted_ = texts.unionByName(marks).repartition("conv").sortWithinPartitions(*keys)
    columns = ["conv", "turn", "role", "text", "slots"]

    def rows(batches):
        now, conv = None, None
        for batch in batches:
            for conv_, turn, role, text, slots in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns)):
                if role is None:  # the conversation's own row comes first
                    if now:
                        yield from now.close()
                    conv, now = conv_, _Writer(conv_, slots)
                elif text is None:
                    now.slots, now.at = slots, 0
                else:
                    yield from now.write(turn, role, text)
        if now:
            yield from now.close()

    written = in_arrow(sorted_.select(*columns), rows, "conv_id long, place long, edit string, turn long, role string, text string", flush=2000)
    return reports, written


class _Writer:
    """Replays the edits of one conversation."""

    def __init__(self, conv, closing: str):
        self.conv, self.closing, self.state, self.place = conv, closing, START, 0
        self.slots, self.at = "", 0

    def _row(self, edit, turn, role, text) -> tuple:
        self.place += 1
        return self.conv, self.place - 1, edit, turn, role, text

    def _next(self) -> str:
        self.state = INSERTED[self.state]
        return "user" if self.state == USER else "assistant"

    def _edits(self, letters: str, turn, role, text):
        for letter in letters.translate(LETTERS):
            if letter == "I":
                yield self._row("I", None, self._next(), "")
            elif letter == "R":
                yield self._row("R", turn, self._next(), text)
            elif letter == "K":
                if role[:1] == "s":
                    self.state = SYSTEM
                else:
                    self._next()
                yield self._row("K", turn, role, text)

    def write(self, turn, role, text):
        letters = self.slots[self.at : self.at + 3]
        self.at += 3
        yield from self._edits(letters, turn, role, text)

    def close(self):
        yield from self._edits(self.closing, None, None, None)


def digests(turns: DataFrame) -> DataFrame:
    """conv_id and SHA-256 of the newline-joined ``role:text`` of ``repair``'s turns, read in their order."""

    def rows(batches):
        conv, tool = None, None
        for batch in batches:
            for conv_, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                line = f"{role}:{text}".encode()
                if tool is None or conv_ != conv:
                    if tool:
                        yield conv, tool.hexdigest()
                    conv, tool = conv_, hashlib.sha256(line)
                else:
                    tool.update(b"\n" + line)
        if tool:
            yield conv, tool.hexdigest()

    return in_arrow(turns.select("conv_id", "role", "text"), rows, "conv_id long, repaired_sha256 string")


def repair_report(conversations: DataFrame, originals: DataFrame) -> DataFrame:
    """The report and the digest of the repaired text, for every conv_id of ``originals``."""
    reports, turns = repair(conversations)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = originals.select(F.col("conv_id").cast("long")).distinct()
    texts = digests(turns).toDF("c2", "repaired_sha256")
    both = every.join(reports.withColumnRenamed("conv_id", "c1"), same_keys({"conv_id": "c1"}), "left").join(
        texts, same_keys({"conv_id": "c2"}), "left"
    )
    return both.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in names],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256"),
    )
