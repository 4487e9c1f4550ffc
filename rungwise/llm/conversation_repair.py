"""Repair of conversation structure by a persistent audit program.

A conversation's rows, in order, are read once. For each state of the legal order of roles
(nothing yet, after the system's, the user's, the assistant's turn) the cheapest edits that
lead there are kept as the last node of a chain: one node per edit, its parent the edits
before it, so that states share their common prefixes. Nodes know their ancestors 1, 2, 4, ...
edits back and a rolling hash of their chain. Of two equally cheap chains the lesser in ASCII
order stays: binary lifting finds the longest common prefix by its hash, equality is then
verified node by node as far as the chains are not shared, and the next edits decide. Chains
of equal cost for the same rows are never prefixes of one another, so the lesser one stays so
whatever follows. What all states agree on is written out, and their nodes let go.

The program needs no text: it reads rows of (conversation, turn, role, digest of the text,
faults). Which rows repeat an earlier one is found by grouping on conversation, role and digest
(SHA-256). The audit is then put before the conversation's rows, and a second pass streams
their texts through it. One task reads a conversation, row by row; besides the open
nodes it holds one letter per edit.

Nulls are one space, also in what is hashed for the damage, but a null id stays null and null
ids are one conversation. Rows of one turn are ordered by role and digest; nulls come first.
Rows that are alike in all of these repeat one another. Empty and long texts have no special
case. A role is legal if it begins with s, u or a. Other columns are not read. An empty table
gives no rows; a conversation that lost all its rows keeps one, with zeros.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rungwise.llm.common import read_table
from rungwise.session import checkpointed

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
START, SYSTEM, USER, ASSISTANT = range(4)  # states
BEFORE_USER = (START, SYSTEM, ASSISTANT)
WHITE = " \t\n\x0b\x0c\r"
BASE, MODULUS = 131, (1 << 61) - 1
FLUSH = 1 << 10  # rows after which agreed edits are written out
LEGAL = {"su", "ua", "au"}
MOST = (1 << 63) - 1
ORDER = ["conv_id", "turn", "role", "digest"]
FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REPAIRED = f"conv_id long, {FIGURES}, repaired_sha256 string"


class Node:
    """The last edit of a chain; ``up[k]`` is the node 2^k edits back."""

    __slots__ = ("depth", "hash", "letter", "up")

    def __init__(self, parent: Node | None = None, letter: str = "", modulus: int = MODULUS):
        self.letter = letter
        if parent is None:
            self.up, self.depth, self.hash = [], 0, 0
            return
        self.up, k = [parent], 0
        while k < len(self.up[k].up):
            self.up.append(self.up[k].up[k])
            k += 1
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + ord(letter)) % modulus

    def ancestor(self, depth: int) -> Node:
        node, steps, k = self, self.depth - depth, 0
        while steps:
            if steps & 1:
                node = node.up[k]
            steps, k = steps >> 1, k + 1
        return node

    def letters(self, top: Node | None = None) -> str:
        """The edits below ``top``, the chain's first by default."""
        out, node = [], self
        while node is not top and node.up:
            out.append(node.letter)
            node = node.up[0]
        return "".join(reversed(out))


def alike(a: Node, b: Node) -> bool:
    """Whether two chains are equal: by hash, then verified down to the first shared node."""
    if a.hash != b.hash or a.depth != b.depth:
        return False
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Node, b: Node) -> bool:
    """ASCII order of two chains, by their longest common prefix."""
    depth = min(a.depth, b.depth)
    x, y = a.ancestor(depth), b.ancestor(depth)
    if x is y or alike(x, y):
        return a.depth < b.depth
    if x.hash != y.hash:
        for k in reversed(range(len(x.up))):
            if k < len(x.up) and x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
        if alike(x.up[0], y.up[0]):
            return x.letter < y.letter
    return a.letters() < b.letters()  # unequal chains with equal hashes


def common(nodes: list[Node]) -> Node:
    """The last node that all chains share."""
    first = nodes[0]
    for other in nodes[1:]:
        depth = min(first.depth, other.depth)
        x, y = first.ancestor(depth), other.ancestor(depth)
        if x is not y:
            for k in reversed(range(len(x.up))):
                if k < len(x.up) and x.up[k] is not y.up[k]:
                    x, y = x.up[k], y.up[k]
            x = x.up[0]
        first = x
    return first


class Audit:
    """The cheapest edits of one conversation, fed row by row."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus, self.written, self.rows = modulus, [], 0
        self.states: list[tuple[int, Node] | None] = [(0, Node()), None, None, None]

    def best(self, options: list[tuple[int, Node, str]]) -> tuple[int, Node] | None:
        """The cheapest option (cost, chain, next edit or none); of several the least in ASCII order."""
        if not options:
            return None
        cost = min(o[0] for o in options)
        chains = [Node(node, edit, self.modulus) if edit else node for c, node, edit in options if c == cost]
        least = chains[0]
        for chain in chains[1:]:
            if less(chain, least):
                least = chain
        return cost, least

    def inserted(self) -> list[tuple[int, Node] | None]:
        """States after any useful inserts: a user's turn, an assistant's, or both."""
        now = list(self.states)
        for state, before in ((USER, BEFORE_USER), (ASSISTANT, (USER,))):
            options = [(*now[state], "")] if now[state] else []
            options += [(now[p][0] + INSERT, now[p][1], "I") for p in before if now[p]]
            now[state] = self.best(options)
        return now

    def row(self, initial: str, lost: bool, truncated: bool) -> None:
        """One row by its role's initial; ``lost`` rows must be deleted."""
        now, extra, after = self.inserted(), TRUNCATED if truncated else 0, []
        for state, before, own in ((START, (), ""), (SYSTEM, (START,), "s"), (USER, BEFORE_USER, "u"), (ASSISTANT, (USER,), "a")):
            options = [(now[state][0] + DELETE, now[state][1], "D")] if now[state] else []
            if not lost and (initial == own or state >= USER):
                cost, edit = (KEEP, "K") if initial == own else (REROLE, "R")
                options += [(now[p][0] + cost + extra, now[p][1], edit) for p in before if now[p]]
            after.append(self.best(options))
        done = after[ASSISTANT]
        # What can follow nothing can follow an assistant's turn for at most one more deletion; what can follow the
        # system's turn, for no more. Beyond that these states cannot win, and all others soon share their edits.
        for state, most in ((START, DELETE), (SYSTEM, 0)):
            if done and after[state] and after[state][0] > done[0] + most:
                after[state] = None
        self.states, self.rows = after, self.rows + 1
        if self.rows % FLUSH == 0:
            self.flush()

    def flush(self) -> None:
        """Writes out what all states agree on and hangs the rest below a new first node."""
        top = common([state[1] for state in self.states if state])
        if top.up:
            self.written.append(top.letters())
            moved = {id(top): Node()}
            for state in self.states:
                chain, node = [], state and state[1]
                while node is not None and id(node) not in moved:
                    chain.append(node)
                    node = node.up[0]
                for node in reversed(chain):
                    moved[id(node)] = Node(moved[id(node.up[0])], node.letter, self.modulus)
            self.states = [state and (state[0], moved[id(state[1])]) for state in self.states]

    def result(self) -> tuple[int, str]:
        """(cost, edits) that end in an empty conversation or after an assistant's turn."""
        now = self.inserted()
        cost, chain = self.best([(*now[state], "") for state in (START, ASSISTANT) if now[state]])
        return cost, "".join(self.written) + chain.letters()


def spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows as the damage leaves them, nulls as one space; dropped ones with 0 copies."""
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, copies, blank, truncated, again) without texts; ``again``: an earlier turn says the same."""
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    light = rows.select(
        "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "copies", (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    same = light.filter("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    # Written, so that the join has plain exchanges on both sides and a row said very often can be split.
    said = checkpointed(same.filter("first < last").select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first"))
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    again = F.coalesce(F.col("first") < order, F.lit(False))
    return light.join(said, on, "left").select(*light.columns, again.alias("again"))


def by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows as tuples, the id first."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def table_rows(rows: Iterator[tuple], schema: str, size: int = 512) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of a schema of longs and strings."""
    fields = [f.strip().split(" ") for f in schema.split(",")]
    kinds = pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind in fields])

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds.types)], schema=kinds)

    held, letters = [], 0
    for row in rows:
        held.append(row)
        letters += len(row[7])
        if len(held) == size or letters > 1 << 20:
            yield batch(held)
            held, letters = [], 0
    if held:
        yield batch(held)


def audited(light: DataFrame) -> DataFrame:
    """(conv_id, FIGURES) of every conversation of ``faults``."""
    names = [*ORDER, "copies", "blank", "truncated", "again"]

    def conversations(batches):
        conv, state = None, None

        def closed():
            cost, edits = state["audit"].result()
            known = state["known"]
            gaps = min(MOST, known[1] - known[0] + 1 - known[2]) if known else 0
            return (conv, gaps, *(state[n] for n in ("blank", "duplicate", "truncated", "illegal")), cost, edits)

        for own, turn, role, digest, copies, blank, truncated, again in by_conversation(batches):
            if state is None or own != conv:
                if state is not None:
                    yield closed()
                conv = own
                state = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "audit": Audit(), "known": None, "row": None, "initial": None}
            if copies and turn is not None:
                first, last, distinct = state["known"] or (turn, None, 0)
                state["known"] = (first, turn, distinct + (turn != last))
            for _ in range(copies):
                duplicate = not blank and (again or state["row"] == (turn, role, digest))
                cut = truncated and not blank and not duplicate
                initial = role[:1]
                if state["row"] is not None and state["initial"] + initial not in LEGAL:
                    state["illegal"] += 1
                state["blank"] += blank
                state["duplicate"] += duplicate
                state["truncated"] += cut
                state["audit"].row(initial, blank or duplicate, cut)
                state["row"], state["initial"] = (turn, role, digest), initial
        if state is not None:
            yield closed()

    def run(batches):
        yield from table_rows(conversations(batches), "conv_id long, " + FIGURES)

    placed = light.select(names).repartition("conv_id").sortWithinPartitions(*ORDER)
    return placed.mapInArrow(run, "conv_id long, " + FIGURES)


def repaired_rows(edits: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of a repaired conversation from its edits and its rows as they are."""
    last = ""
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if last == "u" else "user"
        last = role[:1]
        yield role, text


def repair(rows: DataFrame) -> DataFrame:
    """REPAIRED for conversations as they are: rows (conv_id, turn, role, text, copies), see ``damaged``."""
    figures = [f.strip().split(" ")[0] for f in FIGURES.split(",")]
    audits = audited(faults(rows))
    # One kind of rows: the audit of a conversation, then its rows.
    texts = rows.filter("copies > 0").withColumn("digest", F.unhex(F.sha2("text", 256)))
    texts = texts.select("conv_id", F.lit(1).alias("kind"), *ORDER[1:], "text", "copies")
    heads = audits.withColumn("kind", F.lit(0))
    both = heads.unionByName(texts, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER[1:])
    both = both.select("conv_id", "kind", *figures, "role", "text", "copies")

    def run(batches):
        stream = by_conversation(batches)
        ahead: list[tuple] = []

        def rows_of_one():
            for row in stream:
                if row[1] == 0:  # the next conversation's audit
                    ahead.append(row)
                    return
                yield from [(row[-3], row[-2])] * row[-1]

        def conversations():
            first = next(stream, None)
            while first is not None:
                digest, between, own = hashlib.sha256(), b"", rows_of_one()
                for role, text in repaired_rows(first[2 + len(figures) - 1], own):
                    digest.update(between + role.encode() + b":" + text.encode())
                    between = b"\n"
                for _ in own:
                    pass  # reads on to the next conversation
                yield (first[0], *first[2 : 2 + len(figures)], digest.hexdigest())
                first = ahead.pop() if ahead else None

        yield from table_rows(conversations(), REPAIRED)

    return both.mapInArrow(run, REPAIRED)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(read_table(spark, sf_dir, "conversations")))


def _crc32_sql(text: str) -> str:
    """CRC-32 of a short ASCII string, bit by bit; the polynomial is a fixed value."""
    byte = "list_reduce(list_prepend(xor(c, b), [0::BIGINT FOR i IN range(8)]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    codes = f"list_transform(string_split({text}, ''), lambda s: ord(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


def _chain(state: str, cost: str, edit: str, line: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {state}.t || {line}}}"


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


_ROW = "chr(10) || role || ':' || text"
_NEVER = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}"
_AS_USER = "CASE WHEN i = 'u' THEN role ELSE 'user' END"
_AS_ASSISTANT = "CASE WHEN i = 'a' THEN role ELSE 'assistant' END"


def _placed(state: str, initial: str, role: str) -> str:
    """Keep or rerole, as one option; a lost row has none."""
    cost = f"CASE WHEN lost THEN 1000000000 ELSE CASE WHEN i = '{initial}' THEN 0 ELSE 3 END + extra END"
    line = f"chr(10) || {role} || ':' || text"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || CASE WHEN i = '{initial}' THEN 'K' ELSE 'R' END, 't': {state}.t || {line}}}"


_USER_LINE, _ASSISTANT_LINE = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
_W2 = _least("v2", *(_chain(v, "3", "I", _USER_LINE) for v in ("v0", "v1", "v3")))
OP13_SQL = f"""
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind FROM conversations
), rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM coded
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS nth FROM rows
), marked AS (
  SELECT *, role[1] AS i, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nth) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY nth) AS before FROM placed
), faults AS (
  SELECT conv_id, nth, turn, role, text, i, blank, NOT blank AND again AS duplicate, NOT blank AND NOT again AND cut AS truncated,
    before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au') AS illegal, blank OR again AS lost,
    CASE WHEN NOT blank AND NOT again AND cut THEN 3 ELSE 0 END AS extra FROM marked
), walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS nth, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS v0, {_NEVER} AS v1, {_NEVER} AS v2, {_NEVER} AS v3
  FROM conversations
  UNION ALL
  SELECT conv_id, nth, {_chain("v0", "4", "D")},
    {_least(_chain("v1", "4", "D"), f"{{'c': v0.c + CASE WHEN lost OR i <> 's' THEN 1000000000 ELSE extra END, 'a': v0.a || 'K', 't': v0.t || {_ROW}}}")},
    {_least(_chain("w2", "4", "D"), *(_placed(v, "u", _AS_USER) for v in ("v0", "v1", "w3")))},
    {_least(_chain("w3", "4", "D"), _placed("w2", "a", _AS_ASSISTANT))}
  FROM (
    SELECT *, {_least("v3", _chain("w2", "3", "I", _ASSISTANT_LINE))} AS w3 FROM (
      SELECT w.conv_id, f.nth, f.role, f.text, f.i, f.lost, f.extra, v0, v1, v3, {_W2} AS w2
      FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.nth = w.nth + 1))
), ends AS (
  SELECT conv_id, {_least("v0", "v3", _chain("w2", "3", "I", _ASSISTANT_LINE))} AS best FROM (
    SELECT conv_id, v0, v3, {_W2} AS w2, nth, max(nth) OVER (PARTITION BY conv_id) AS last FROM walk) WHERE nth = last
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(blank)::BIGINT AS blank,
    count_if(duplicate)::BIGINT AS duplicate, count_if(truncated)::BIGINT AS truncated, count_if(illegal)::BIGINT AS illegal
  FROM faults GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
  sha256(substr(best.t, 2)) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
