"""Conversations brought into order at the least cost: layers of reachable grammar states, one for each cost.

A conversation is in order if its roles read ``(s?(ua)+)?``. Layer c holds for
each place between turns a set of bits: the grammar states from which the turns
that follow can be brought into order at cost c. A layer comes from the ones
below it, by the costs of the edits, and from its own later places, by turns
that stay. The first layer that holds the first state at the first place gives
the cost. The audit is read off by going through the layers from the first
turn, each time by the least letter whose target is in its layer.

Turns are dealt by ranges of (conversation, turn), so a long conversation lies
over many tasks. A conversation that lies within one task, and is not long, is
solved there. The others are cut into chunks: each chunk finds what it costs to
get from each state to each other, a pass from the last chunk to the first adds
these up, each chunk then reads off an audit for every state that it may be
entered in, and a pass from the first to the last picks one. The two passes see
only a few numbers and letters of a chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, table

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
CHUNK_TURNS = 128
CHUNK_BYTES = 4_000_000
BLANKS = " \t\n\r\x0b\x0c"
#: States as bits: nothing yet, after a system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = 1, 2, 4, 8
STATES = (EMPTY, SYSTEM, USER, ASSISTANT)
#: What an inserted or reassigned turn has to be in a state, and the state after it.
NEXT = {EMPTY: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: States that a kept turn leads to, by the first letter of its role.
KEPT = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = {"su", "ua", "au"}
#: Turns to be inserted at the end, by the state reached.
TAIL = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
FINAL = [INSERT * len(TAIL[s]) for s in STATES]


def _sources(step: dict[int, int]) -> list[int]:
    """For each set of states the set of those that the step leads into it from."""
    return [sum(s for s, to in step.items() if to & bits) for bits in range(16)]


_INTO = _sources({s: to for s, (_, to) in NEXT.items()})
_KEPT_INTO = {letter: _sources(step) for letter, step in KEPT.items()}
_NONE = [0] * 16


class Turn(NamedTuple):
    """A turn as the grammar sees it: first letter of the role, fault, and how many equal turns follow it."""

    letter: str
    fault: str
    more: int

    @property
    def lost(self) -> bool:
        return self.fault in ("blank", "duplicate")


def fault_of(text: str, first: bool) -> str:
    """blank, duplicate (``first`` false: role and text were seen before), truncated, or nothing."""
    solid = text.strip(BLANKS)
    if not solid:
        return "blank"
    if not first:
        return "duplicate"
    return "" if solid[-1] in ".!?" else "truncated"


def certain_cost(turns: list[Turn]) -> int:
    """What the turns cost whatever is done: deletions that are required, and turns cut short."""
    return sum(DELETE * (t.more + t.lost) + TRUNCATED * (t.fault == "truncated") for t in turns)


def _delete_cost(turn: Turn) -> int:
    return DELETE - TRUNCATED * (turn.fault == "truncated")


def cost_layers(turns: list[Turn], ends: list[int | None], wanted: int) -> list[list[int]]:
    """Layers of costs past the certain ones; ``ends``: the cost still to come in each state after the last turn.

    Stops when all ``wanted`` states are found at the first place, or no further one can be.
    """
    n, layers, seen = len(turns), [], 0
    most = sum(_delete_cost(t) for t in turns) + 3 * INSERT + max((e for e in ends if e is not None), default=0)
    steps = [None if t.lost else (_KEPT_INTO.get(t.letter, _NONE), _delete_cost(t)) for t in turns]
    for cost in range(most + 1):
        layer = [0] * (n + 1)
        layer[n] = sum(s for s, e in zip(STATES, ends, strict=True) if e == cost)
        below = layers[cost - INSERT] if cost >= INSERT else None
        for i in range(n - 1, -1, -1):
            if steps[i] is None:
                bits = layer[i + 1]
            else:
                kept, price = steps[i]
                bits = kept[layer[i + 1]]
                if cost >= price:
                    bits |= layers[cost - price][i + 1]
                if below:
                    bits |= _INTO[below[i + 1]]  # REROLE costs as much as INSERT
            if below:
                bits |= _INTO[below[i]]
            layer[i] = bits
        layers.append(layer)
        seen |= layer[0]
        if seen & wanted == wanted:
            break
    return layers


def first_layer(layers: list[list[int]], state: int) -> int | None:
    return next((cost for cost, layer in enumerate(layers) if layer[0] & state), None)


def read_audit(turns: list[Turn], layers: list[list[int]], state: int) -> tuple[str, int]:
    """The least audit from a state at the first place, and the state that it ends in."""
    left, out = first_layer(layers, state), []
    for i, turn in enumerate(turns):
        while not turn.lost:
            price, kept = _delete_cost(turn), KEPT.get(turn.letter, {}).get(state, 0)
            if left >= price and layers[left - price][i + 1] & state:
                left, letter = left - price, "D"
            elif left >= INSERT and layers[left - INSERT][i] & NEXT[state][1]:
                left, letter, state = left - INSERT, "I", NEXT[state][1]
            elif layers[left][i + 1] & kept:
                letter, state = "K", kept
            else:
                left, letter, state = left - REROLE, "R", NEXT[state][1]
            out.append(letter)
            if letter != "I":
                break
        else:
            out.append("D")
        out.append("D" * turn.more)
    return "".join(out), state


def replay(roles: list[str], texts: list[str], copies: list[int], audit: str, state: int) -> tuple[list[str], list[str]]:
    """The turns that an audit leaves, entered in a state."""
    out: tuple[list[str], list[str]] = ([], [])
    at = skip = 0
    for letter in audit:
        if skip:
            skip -= 1
            continue
        role = NEXT[state][0] if letter in "IR" else roles[at] if letter == "K" else None
        if role is not None:
            out[0].append(role)
            out[1].append("" if letter == "I" else texts[at])
            state = NEXT[state][1] if letter in "IR" else KEPT[role[:1]][state]
        if letter != "I":
            skip, at = copies[at] - 1, at + 1
    return out


#: Counts of a run of turns that can be joined to those of the next run.
COUNTS = "turns_in long, blank long, duplicate long, truncated long, illegal long, head string, tail string, lo long, hi long, distinct_turns long, first_turn long, last_turn long"


def run_counts(turns: list[Turn], numbers: list[int | None]) -> dict:
    known = [n for n in numbers if n is not None]
    out = {"turns_in": sum(t.more + 1 for t in turns), "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    for t in turns:
        if t.fault:
            out[t.fault] += 1
        out["blank" if t.fault == "blank" else "duplicate"] += t.more
        out["illegal"] += t.more
    out["illegal"] += sum(a.letter + b.letter not in LEGAL for a, b in zip(turns, turns[1:], strict=False))
    out |= {"head": turns[0].letter, "tail": turns[-1].letter, "distinct_turns": len(set(known))}
    ends = (known[0], known[-1]) if known else (None, None)
    return out | {"lo": ends[0], "hi": ends[1], "first_turn": ends[0], "last_turn": ends[1]}


def joined_counts(a: dict | None, b: dict) -> dict:
    """Counts of a run and of the one that follows it."""
    if a is None:
        return dict(b)
    out = {k: a[k] + b[k] for k in ("turns_in", "blank", "duplicate", "truncated", "illegal", "distinct_turns")}
    out["illegal"] += a["tail"] + b["head"] not in LEGAL
    if a["last_turn"] is not None and a["last_turn"] == b["first_turn"]:
        out["distinct_turns"] -= 1
    out |= {"head": a["head"], "tail": b["tail"], "lo": b["lo"] if a["lo"] is None else a["lo"], "hi": a["hi"] if b["hi"] is None else b["hi"]}
    return out | {"first_turn": b["first_turn"] if a["first_turn"] is None else a["first_turn"], "last_turn": a["last_turn"] if b["last_turn"] is None else b["last_turn"]}


_KEY = "conv_id long, part int, seq int"
_ROWS = "numbers array<long>, roles array<string>, texts array<string>, copies array<long>"
_PIECE = "audit string, out_roles array<string>, out_texts array<string>"
_DEALT = f"{_KEY}, closed boolean, {_ROWS}, {_PIECE}, cost long, {COUNTS}"
_COUNT_NAMES = [c.split()[0] for c in COUNTS.split(", ")]


def _batch(rows: list[dict], like: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, like)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in kinds.items()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _solved(numbers: list, roles: list, texts: list, copies: list) -> dict:
    """A whole conversation, held in one task."""
    seen: set[tuple[str, str]] = set()
    turns = []
    for role, text, n in zip(roles, texts, copies, strict=True):
        turns.append(Turn(role[:1], fault_of(text, (role, text) not in seen), n - 1))
        seen.add((role, text))
    layers = cost_layers(turns, FINAL, EMPTY)
    audit, state = read_audit(turns, layers, EMPTY)
    audit += TAIL[state]
    out_roles, out_texts = replay(roles, texts, copies, audit, EMPTY)
    cost = certain_cost(turns) + first_layer(layers, EMPTY)
    return {"audit": audit, "out_roles": out_roles, "out_texts": out_texts, "cost": cost, **run_counts(turns, numbers)}


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns (conv_id, turn, role, text) to solved conversations and to chunks of those that may go on elsewhere."""
    like, part, seq = _arrow(_DEALT), TaskContext.get().partitionId(), 0
    conv, held, size, opened, out = None, None, 0, True, []

    def row(closed: bool) -> dict:
        cols = dict(zip(("numbers", "roles", "texts", "copies"), map(list, zip(*held, strict=True)), strict=True))
        head = {"conv_id": conv[0], "part": part, "seq": seq, "closed": closed}
        return head | (_solved(**cols) if closed else cols)

    for batch in batches:
        for conv_id, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if held is None or conv[0] != conv_id:
                if held:
                    out.append(row(closed=not opened))
                    seq += 1
                opened = held is None  # what comes first in a task may have begun in another
                conv, held, size = (conv_id,), [], 0
            if held and held[-1][:3] == [turn, role, text]:
                held[-1][3] += 1
                continue
            if len(held) >= CHUNK_TURNS or size > CHUNK_BYTES:
                out.append(row(closed=False))
                seq, opened, held, size = seq + 1, True, [], 0
            held.append([turn, role, text, 1])
            size += len(text)
        if out:
            yield _batch(out, like)
            out = []
    if held:
        yield _batch([*out, row(closed=False)], like)


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs of chunks from the last to the first of each conversation, to what comes after each and from its start on."""
    like, conv, after = _arrow("part int, seq int, ends array<long>, total long"), None, None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if conv != (r["conv_id"],):
                conv, after = (r["conv_id"],), FINAL
            ends = after
            moves = [[c + e for c, e in zip(r["costs"][4 * k : 4 * k + 4], ends, strict=True) if c is not None and e is not None] for k in range(4)]
            after = [min(m, default=None) for m in moves]
            out.append({"part": r["part"], "seq": r["seq"], "ends": ends, "total": after[0]})
        yield _batch(out, like)


def _turns(r: dict) -> list[Turn]:
    first = set(r["first"] or ())
    return [Turn(role[:1], fault_of(text, i in first), n - 1) for i, (role, text, n) in enumerate(zip(r["roles"], r["texts"], r["copies"], strict=True))]


def _moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks to their counts and to the cost from each state to each other one (16, null where there is no way)."""
    like = _arrow(f"{_KEY}, costs array<long>, {COUNTS}")
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            turns = _turns(r)
            certain, costs = certain_cost(turns), [[None] * 4 for _ in STATES]
            for e in range(4):
                layers = cost_layers(turns, [0 if k == e else None for k in range(4)], 15)
                for s, state in enumerate(STATES):
                    past = first_layer(layers, state)
                    costs[s][e] = None if past is None else certain + past
            out.append({k: r[k] for k in ("conv_id", "part", "seq")} | {"costs": sum(costs, [])} | run_counts(turns, r["numbers"]))
        yield _batch(out, like)


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks that know what comes after them to an audit and the state after it, for each state before."""
    like = _arrow(f"{_KEY}, total long, audits array<string>, states array<int>")
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            turns = _turns(r)
            least = min(e for e in r["ends"] if e is not None)
            layers = cost_layers(turns, [None if e is None else e - least for e in r["ends"]], 15)
            found = [("", 0) if first_layer(layers, s) is None else read_audit(turns, layers, s) for s in STATES]
            out.append({k: r[k] for k in ("conv_id", "part", "seq", "total")} | {"audits": [a for a, _ in found], "states": [s for _, s in found]})
        yield _batch(out, like)


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Choices of chunks from the first to the last of each conversation; the last one has the counts of all."""
    like = _arrow(f"part int, seq int, entered int, audit string, cost long, {COUNTS}")
    held = counts = conv = None
    state, cost = EMPTY, 0

    def last() -> dict:
        return held | {"audit": held["audit"] + TAIL[state], "cost": cost} | counts

    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if conv != (r["conv_id"],):
                if held:
                    out.append(last())
                conv, counts, state, cost = (r["conv_id"],), None, EMPTY, r["total"]
            elif held:
                out.append(held)
            counts = joined_counts(counts, {c: r[c] for c in _COUNT_NAMES})
            at = STATES.index(state)
            held = {"part": r["part"], "seq": r["seq"], "entered": state, "audit": r["audits"][at]}
            state = r["states"][at]
        yield _batch(out, like)
    if held:
        yield _batch([last()], like)


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    like = _arrow(f"{_KEY}, {_PIECE}, cost long, {COUNTS}")
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            roles, texts = replay(r["roles"], r["texts"], r["copies"], r["audit"], r["entered"])
            out.append({c: r[c] for c in like.names if c in r} | {"out_roles": roles, "out_texts": texts})
        yield _batch(out, like)


def _with_first(chunks: DataFrame) -> DataFrame:
    """Chunks and the places in each where a role and text of the conversation stand for the first time."""
    each = chunks.select("conv_id", "part", "seq", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "turn"))
    keyed = each.select("conv_id", F.col("turn.roles").alias("role"), F.sha2("turn.texts", 256).alias("digest"), F.struct("part", "seq", "at").alias("place"))
    found = keyed.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("place"))
    places = found.groupBy("place.part", "place.seq").agg(F.collect_list("place.at").alias("first"))  # as many as the chunk's turns
    return chunks.join(places, ["part", "seq"], "left")


def _in_order(df: DataFrame, *order) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def repair(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) to pieces of repaired conversations.

    One row for each run of turns: conv_id, part and seq (its place), audit
    (letters of the edits), out_roles and out_texts (the turns left), and on the
    last piece of a conversation the cost and the counts of the turns given.
    Conversations go by turn, null first, then role and the SHA-256 of the text.
    Null roles and texts count as one space; null conv_ids make one conversation.
    Repeated turns are duplicates. Other columns are left out. No turns, no rows.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    ).withColumns({"digest": F.sha2("text", 256), "number": F.monotonically_increasing_id()})
    # the number deals equal turns, which need no order, over several tasks
    sorted_ = rows.repartitionByRange("conv_id", "turn", "role", "digest", "number").sortWithinPartitions("conv_id", "turn", "role", "digest")
    dealt = staged(sorted_.select("conv_id", "turn", "role", "text").mapInArrow(_dealt, _DEALT), "repair-dealt")
    piece_cols = ["conv_id", "part", "seq", "audit", "out_roles", "out_texts", "cost", *_COUNT_NAMES]
    chunks = staged(_with_first(dealt.where("not closed").select("conv_id", "part", "seq", "numbers", "roles", "texts", "copies")), "repair-chunks")
    moves = staged(chunks.mapInArrow(_moves, f"{_KEY}, costs array<long>, {COUNTS}"), "repair-moves")
    backward = _in_order(moves.select("conv_id", "part", "seq", "costs"), F.desc("part"), F.desc("seq"))
    exits = backward.mapInArrow(_exits, "part int, seq int, ends array<long>, total long")
    choices = chunks.join(exits, ["part", "seq"]).mapInArrow(_choices, f"{_KEY}, total long, audits array<string>, states array<int>")
    forward = _in_order(choices.join(moves.drop("conv_id", "costs"), ["part", "seq"]), "part", "seq")
    picked = forward.mapInArrow(_picked, f"part int, seq int, entered int, audit string, cost long, {COUNTS}")
    solved = chunks.join(picked, ["part", "seq"]).mapInArrow(_replayed, f"{_KEY}, {_PIECE}, cost long, {COUNTS}")
    return dealt.where("closed").select(piece_cols).union(staged(solved, "repair-pieces").select(piece_cols))


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """The turns left, one row each: conv_id, part, seq and at (in this order), role, text."""
    return pieces.select("conv_id", "part", "seq", F.posexplode(F.arrays_zip("out_roles", "out_texts")).alias("at", "t")).select("conv_id", "part", "seq", "at", F.col("t.out_roles").alias("role"), F.col("t.out_texts").alias("text"))


_DIGEST = "conv_id long, audit string, repaired_sha256 string"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    like, conv, digest, audit, any_yet = _arrow(_DIGEST), None, None, [], False
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if conv != (r["conv_id"],):
                if conv:
                    out.append({"conv_id": conv[0], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
                conv, digest, audit, any_yet = (r["conv_id"],), hashlib.sha256(), [], False
            audit.append(r["audit"])
            for role, text in zip(r["out_roles"], r["out_texts"], strict=True):
                digest.update(f"{chr(10) if any_yet else ''}{role}:{text}".encode())
                any_yet = True
        yield _batch(out, like)
    if conv:
        yield _batch([{"conv_id": conv[0], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], like)


def digests(pieces: DataFrame) -> DataFrame:
    """Audit and SHA-256 of each repaired conversation; a digest of one text is made piece after piece, in one task."""
    return _in_order(pieces.select("conv_id", "part", "seq", "audit", "out_roles", "out_texts"), "part", "seq").mapInArrow(_digested, _DIGEST)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with known faults, chosen by crc32 of ``conv_id:turn`` modulo 20; nulls count as one space."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    new_text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    cols = ["conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), new_text.alias("text")]
    return turns.where(kind != 0).select(*cols, F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def summary(turns: DataFrame) -> DataFrame:
    """One row for each conversation that has turns: faults, cost, audit and SHA-256 of the repaired one."""
    pieces = repair(turns)
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("distinct_turns"), F.lit(0)).alias("gaps")
    counts = pieces.where("cost is not null").select(F.col("conv_id").alias("__conv"), gaps, "blank", "duplicate", "truncated", "illegal", "cost")
    named = digests(pieces)
    return named.join(counts, named.conv_id.eqNullSafe(F.col("__conv"))).drop("__conv")


def op11_repair_layers(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found = summary(damaged(turns)).withColumnRenamed("conv_id", "__conv")
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def _crc_sql(text: str) -> str:
    """CRC-32 of an ASCII text in DuckDB SQL, four bits at a time."""
    steps = list(range(16))
    for _ in range(4):
        steps = [(c >> 1) ^ (0xEDB88320 if c & 1 else 0) for c in steps]
    for_bits = lambda x: f"xor(({x}) >> 4, ({steps})[(({x}) & 15)::INT + 1]::BIGINT)"
    byte = for_bits(for_bits("xor(c, b)"))
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)), lambda c, b: {byte}))"


def _least_sql(*ways: str) -> str:
    return f"list_min(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))"


def _way_sql(state: str, cost: int, letter: str, turn: str | None, when: str = "TRUE") -> str:
    turns = f"list_append({state}.t, {turn})" if turn else f"{state}.t"
    return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost} + (CASE WHEN '{letter}' IN ('K', 'R') AND fault = 'truncated' THEN {TRUNCATED} ELSE 0 END), 'a': {state}.a || '{letter}', 't': {turns}}} END"


def _step_sql() -> str:
    """States before a turn (e, s, u2, a2) to those after it."""
    kept, free = "role || ':' || text", "fault NOT IN ('blank', 'duplicate')"
    lost = {x: _way_sql(x, DELETE, "D", None) for x in ("e", "s", "u2", "a2")}
    user = [_way_sql(x, *how) for x in ("e", "s", "a2") for how in ((0, "K", kept, f"{free} AND letter = 'u'"), (REROLE, "R", "'user:' || text", free))]
    other = [_way_sql("u2", *how) for how in ((0, "K", kept, f"{free} AND letter = 'a'"), (REROLE, "R", "'assistant:' || text", free))]
    system = _way_sql("e", 0, "K", kept, f"{free} AND letter = 's'")
    return f"{lost['e']} AS e, {_least_sql(lost['s'], system)} AS s, {_least_sql(lost['u2'], *user)} AS u, {_least_sql(lost['a2'], *other)} AS a"


_USER_IN = _least_sql("u", *[_way_sql(x, INSERT, "I", "'user:'") for x in ("e", "s", "a")])
_ASSISTANT_IN = _least_sql("a", _way_sql("u2", INSERT, "I", "'assistant:'"))
_NULL_WAY = "NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])"

#: Row by row over all conversations at once: for each grammar state the least (cost, audit) that leads to it.
OP11_SQL = f"""
WITH RECURSIVE kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM damaged),
marked AS (
  SELECT *, substr(role, 1, 1) AS letter, regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g') AS solid,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM numbered),
turns AS (
  SELECT conv_id, turn, role, text, i, letter,
    CASE WHEN solid = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    coalesce(lag(letter) OVER (PARTITION BY conv_id ORDER BY i) || letter NOT IN ('su', 'ua', 'au'), FALSE) AS bad FROM marked),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal, count(*) AS n
  FROM turns GROUP BY conv_id),
ways AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''::VARCHAR, 't': []::VARCHAR[]}} AS e, {_NULL_WAY} AS s, {_NULL_WAY} AS u, {_NULL_WAY} AS a FROM counts
  UNION ALL
  SELECT conv_id, i, {_step_sql()} FROM (SELECT *, {_ASSISTANT_IN} AS a2 FROM (
    SELECT w.conv_id, r.i, r.role, r.text, r.letter, r.fault, e, s, a, {_USER_IN} AS u2
    FROM ways w JOIN turns r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1))),
best AS (
  SELECT conv_id, {_least_sql("e", "a2")} AS w FROM (SELECT *, {_ASSISTANT_IN} AS a2 FROM (
    SELECT w.conv_id, '' AS fault, e, a, {_USER_IN} AS u2 FROM ways w JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n)))
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(w.c, 0) AS cost, coalesce(w.a, '') AS audit, sha256(coalesce(array_to_string(w.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
"""
