"""Repairs against all edit scripts, and long conversations over many batches."""

import hashlib
import heapq
import random
import re
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import turns
from tidemark.llm.queries import REGISTRY

GOOD = re.compile(r"(s?(ua)+)?\Z")
COLUMNS = "conv_id long, turn long, role string, text string"


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_repair(rows, faults):
    """The cheapest script by searching scripts in order of (cost, letters)."""
    heap, done = [(0, "", 0, (), ())], set()
    while heap:
        cost, audit, at, initials, lines = heapq.heappop(heap)
        if at == len(rows) and GOOD.match("".join(initials)):
            return cost, audit, "\n".join(lines)
        if (at, audit) in done or len(initials) > 2 * len(rows) + 2:
            continue
        done.add((at, audit))

        def go(add, letter, step, initial=None, line=None):
            then = initials + ((initial,) if initial is not None else ())
            # Only prefixes that can still become right.
            if re.match(r"(s?(ua)*u?)?\Z", "".join(then)) and all(then):
                heapq.heappush(heap, (cost + add, audit + letter, at + step, then, lines + ((line,) if line is not None else ())))

        for role in ("user", "assistant"):
            go(2, "I", 0, role[0], role + ":")
        if at < len(rows):
            role, text = rows[at]
            more = faults[at] == "truncated"
            go(3, "D", 1)
            if faults[at] not in ("blank", "duplicate"):
                go(more, "K", 1, role[:1], f"{role}:{text}")
                for other in ("user", "assistant"):
                    go(2 + more, "R", 1, other[0], f"{other}:{text}")
    raise AssertionError


def report_of(conv_id, rows):
    """rows: (turn, role, text) in order."""
    pairs = [(r, t) for _, r, t in rows]
    faults = faults_of(pairs)
    cost, audit, text = brute_repair(pairs, faults)
    numbers = [n for n, _, _ in rows if n is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
    return (conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def sort_key(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, text)


def some_conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for k in range(rng.randrange(0, 6)):
            turn = rng.choice([None, k, k, k, 3 * k])
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""])
            rows.append((conv, turn, role, rng.choice(["a.", "b!", "c", "d? \n", None, " ", "", f"t{k}.", f"u{k}.", "a."])))
    return rows


def test_reports_against_all_scripts(spark):
    rows = some_conversations(1, 150) + [(None, 1, "user", "x."), (None, 0, "assistant", "y")]
    df = spark.createDataFrame([(*r, 7, "z") for r in rows], COLUMNS + ", place int, fault string")
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    want = sorted((report_of(c, sorted(v, key=sort_key)) for c, v in by.items()), key=repr)
    assert sorted(map(tuple, turns.repair_report(df).collect()), key=repr) == want
    # The repaired rows are what the hash is of.
    lines = {}
    for r in turns.repaired_turns(df).orderBy("place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {w[0]: w[-1] for w in want} == {c: hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() for c in by}
    assert turns.repair_report(df.limit(0)).count() == 0 and turns.repaired_turns(df.limit(0)).count() == 0


def test_query_against_brute_force(spark, tmp_path):
    rows = [r for k in range(4) for r in ((c + 1000 * k, *x) for c, *x in some_conversations(k, 90))]
    rows += [(None, 2, "user", "hi."), (None, None, None, None)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "conversations.parquet"))
    by = {}
    for conv, turn, role, text in rows:
        kept = by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    want = sorted((report_of(c, sorted(v, key=sort_key)) for c, v in by.items()), key=repr)
    assert any(not v for v in by.values())
    assert sorted(map(tuple, REGISTRY["op12_conversation_repair"](spark, str(tmp_path)).collect()), key=repr) == want


def test_costs_go_from_batch_to_batch(spark):
    """A conversation of many batches is repaired as one."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        n = 5000
        rows = spark.range(n).select(
            F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"),
            F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(".")).alias("text"),
        )
        whole = turns.repair_report(rows).collect()
        assert [(r.cost, r.audit) for r in whole] == [(0, "K" * n)]
        # Two rows lost, far apart: one role twice at each place.
        cut = turns.repair_report(rows.filter(~F.col("turn").isin(101, 4000))).collect()[0]
        assert cut.gaps == 2 and cut.cost == 4 and len(cut.audit) == n - 2 + cut.audit.count("I")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_one_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "user", "x.")], COLUMNS)
    plan = turns.repair_report(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_packed_edits():
    costs = turns.end_costs()
    assert costs == [0, 4, 2, 0]
    costs, packed = turns.step_back(costs, "u", turns.SOUND)
    assert costs[0] == 2 and turns.edits_at(0, packed) == ([("K", 0)], 0)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 1]), pa.array(["assistant", "user"]), pa.array([0, 0])], ["conv_id", "role", "fault"])
    assert list(turns._plan(iter([batch])))[0].num_rows == 2
