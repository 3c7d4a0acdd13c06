"""Periodic runs, repeated bytes and conversation repair on awkward rows, against brute force."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import bwt_merge, periodic_runs, queries, turn_repair
from sievework.llm.common import shipped

AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (5, "same words here"), (5, "same words here"), (None, "no id here"), (6, "é" * 300), (7, "  a a a a a a")]


# --- periodic runs

def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            stretch = words[a : i + q]
            primitive = all(any(x != y for x, y in zip(stretch, stretch[p:], strict=False)) for p in range(1, q))
            if len(stretch) >= max(6, 4 * q) and primitive:
                out.append((a, len(stretch), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(draw):
    words = []
    for _ in range(draw.randint(0, 8)):
        words += [str(draw.randint(0, 3)) for _ in range(draw.randint(1, 6))] * draw.randint(0, 7)
        if draw.random() < 0.5:
            words.append(f"x{draw.randint(0, 5)}")
    return words


def test_runs_match_brute_force(spark, documents):
    draw = random.Random(4)
    texts = [" ".join(some_words(draw)) for _ in range(300)]
    docs = documents([*AWKWARD, *((100 + i, t) for i, t in enumerate(texts)), (9, "la " * 30_000), (10, "a b c d " * 9000 + "e")])
    by_id = defaultdict(list)
    for row in periodic_runs.find(docs).collect():
        by_id[row["doc_id"]].append(row)
    for i, text in enumerate(texts):
        words = text.split()
        (row,) = by_id[100 + i]
        runs = [(r["start"], r["length"], r["period"]) for r in row["runs"]]
        assert runs == brute_runs(words)
        gone = {k for s, length, p in runs for k in range(s + p, s + length)}
        assert row["collapsed"] == " ".join(w for k, w in enumerate(words) if k not in gone) and row["n_words"] == len(words)
    assert [tuple(r) for r in by_id[9][0]["runs"]] == [(0, 30_000, 1)] and by_id[9][0]["collapsed"] == "la"
    assert [tuple(r) for r in by_id[10][0]["runs"]] == [(0, 36_000, 4)]
    assert len(by_id[5]) == 2 and len(by_id[None]) == 1 and by_id[1][0]["n_words"] == by_id[3][0]["n_words"] == 0
    assert [tuple(r) for r in by_id[7][0]["runs"]] == []  # other blanks than the six of ASCII are part of a word


def test_words_that_erode_one_a_round():
    draw = random.Random(2)
    words = [w for k in range(2000) for w in [k, k, k, k + 1]] + [draw.randint(0, 9) for _ in range(500)]
    texts = [[str(w).encode() for w in words]]
    assert periodic_runs.runs_of(texts) == [periodic_runs.scan(np.array(words))]


def test_best_run_and_ties(spark, documents):
    # 6 x 'a' (6 periods) before 6 x 'b' (as many): the first; 4 x 'c d' has fewer
    found = periodic_runs.report(periodic_runs.find(documents([(1, "a a a a a a b b b b b b c d c d c d c d"), (2, "x")]))).orderBy("doc_id").collect()
    assert found[0][1:6] == (3, 0, 6, 1, 6000) and found[1][1:6] == (0, None, None, None, None)
    assert found[0]["runs_sha256"] == hashlib.sha256(b"0,6,1\n6,6,1\n12,8,2\n").hexdigest()
    assert found[0]["collapsed_sha256"] == hashlib.sha256(b"a b c d").hexdigest()
    assert periodic_runs.report(periodic_runs.find(documents([]))).count() == 0


# --- repeated bytes

def brute_cut(rows, length=bwt_merge.LENGTH):
    texts = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, t in texts:
        for k in range(len(t) - length + 1):
            w = t[k : k + length]
            least[w] = min(least.get(w, float("inf")), float("inf") if i is None else i)
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if least[t[k : k + length]] < (float("inf") if i is None else i):
                gone[k : k + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans, at = [], 0
        for flag, group in itertools.groupby(gone):
            size = len(list(group))
            spans += [(at, at + size)] if flag else []
            at += size
        out.append((i, len(t), tuple(spans), kept))
    return sorted(out, key=repr)


def made(found):
    return sorted([(r["doc_id"], r["n_bytes"], tuple(tuple(s) for s in r["spans"]), bytes(r["kept"])) for r in found.collect()], key=repr)


def passages(seed, docs):
    draw = random.Random(seed)
    common = ["".join(draw.choice("ab é") for _ in range(draw.choice([49, 50, 51, 70, 200]))) for _ in range(6)]
    rows = []
    for i in range(docs):
        text = "".join(draw.choice([*common, "".join(draw.choice("abcdefgh ") for _ in range(draw.randint(0, 80)))]) for _ in range(draw.randint(0, 6)))
        rows.append((draw.randint(0, docs), text))
    return rows


@pytest.mark.parametrize("chunk, hot", [(1 << 24, 64), (4000, 64), (2000, 1)])
def test_bytes_match_brute_force(spark, documents, monkeypatch, chunk, hot):
    """Also with many chunks, and with every sample of two chunks hot."""
    for name, value in (("CHUNK_BYTES", chunk), ("HOT_CHUNKS", hot)):  # the workers import the package: what they read goes with the function
        monkeypatch.setattr(bwt_merge, name, value)
    rows = [*AWKWARD, *passages(hot + chunk, 150), (800, "z" * 400), (801, "z" * 500), (802, "z" * 50), (None, "z" * 60), (803, "z" * 49)]
    assert made(bwt_merge.without_repeats(documents(rows))) == brute_cut(rows)


@pytest.mark.parametrize("block", [64, 1000, 1 << 18])
def test_hot_samples_are_cut_into_windows(monkeypatch, block):
    """The pieces of a hot sample, as single windows, settle to the same smallest ids."""
    draw = random.Random(8)
    base = bytes(draw.choice(b"abc ") for _ in range(300))
    texts = [base[draw.randint(0, 100) :] + bytes(draw.choice(b"xyz") for _ in range(90)) for _ in range(20)]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    monkeypatch.setattr(bwt_merge, "BLOCK", block)
    covered, cut = [], []
    for at, some, window in bwt_merge.pieces(data, ends):
        single = bwt_merge.candidates(some, window, 4, None, np.unique(bwt_merge.known(some.sample, 4)))
        assert (single.first == single.last).all()
        for p, out in ((some, covered), (single, cut)):
            out += [(int(o), at + k) for f, z, o in zip(p.first, p.last, p.owner, strict=True) for k in range(f, z + 1)]
    assert sorted(covered) == sorted(cut)
    assert sorted(covered) == [(i, int(e - len(t)) + k) for i, (t, e) in enumerate(zip(texts, ends, strict=True)) for k in range(len(t) - 49)]


def test_merged_transforms_hold_every_repeated_window():
    draw = random.Random(3)
    base = bytes(draw.choice(b"ab") for _ in range(200))
    for _ in range(40):
        shards, strings = [], []
        for _ in range(draw.randint(1, 4)):
            own = []
            for _ in range(draw.randint(1, 8)):
                at, size = draw.randint(0, 130), draw.randint(50, 68)
                text = bytearray(base[at : at + size])
                if draw.random() < 0.5:
                    text[draw.randrange(size)] = ord("c")
                own.append(bytes(text))
            strings += own
            shards.append((np.frombuffer(b"".join(own), np.uint8), np.array([len(x) for x in own])))
        places = defaultdict(set)
        for j, text in enumerate(strings):
            for k in range(len(text) - 49):
                places[text[k : k + 50]].add((j, k))
        groups = defaultdict(set)
        for j, k, interval in zip(*(x.tolist() for x in bwt_merge.merged(shards, 50)), strict=True):
            groups[interval].add((j, k))
        assert {frozenset(g) for g in groups.values()} == {frozenset(p) for p in places.values() if len(p) > 1}


def test_no_documents_no_bytes(spark, documents):
    assert made(bwt_merge.without_repeats(documents([]))) == []


# --- conversations

def brute_repair(rows):
    """Rows of one conversation in order, (turn, role, text): what the report holds. The ways are followed one by one."""
    blank = [not re.search(r"[^\x20\x09-\x0D]", t) for _, _, t in rows]
    seen, again = set(), []
    for _, role, text in rows:
        again.append((role, text) in seen)
        seen.add((role, text))
    late = [not b and not a and not re.search(r"[.!?][\x20\x09-\x0D]*\Z", t) for b, a, (_, _, t) in zip(blank, again, rows, strict=True)]
    best = {(0, ""): (0, "", ())}  # (row, initials) -> cost, letters, lines; initials are cut to what the grammar needs

    def grammar(initials):
        return re.fullmatch(r"(s?(ua)*u?)?", initials)

    def short(initials):
        return "s" if initials == "s" else "" if not initials else initials[-1]

    heap = [(0, "", 0, "", ())]
    import heapq

    done = set()
    while heap:
        cost, letters, at, last, lines = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            initials = [r[:1] for _, r, _ in rows]
            turns = [t for t, _, _ in rows if t is not None]
            return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, sum(blank), sum(a and not b for a, b in zip(again, blank, strict=True)), sum(late),
                    sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials)), cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
        step = []
        if at < len(rows):
            _, role, text = rows[at]
            step.append((3, "D", at + 1, None, None))
            if not blank[at] and not again[at]:
                step.append((late[at], "K", at + 1, role, text))
                step += [(2 + late[at], "R", at + 1, r, text) for r in ("user", "assistant")]
        step += [(2, "I", at, r, "") for r in ("user", "assistant")]
        for price, letter, to, role, text in step:
            after = last if role is None else {"": "", "s": "s", "u": "u", "a": "ua"}[last] + role[:1]
            if role is not None and not (role[:1] in "sua" and role and grammar(after)):
                continue
            heapq.heappush(heap, (cost + price, letters + letter, to, short(after) if role is not None else last, lines if role is None else (*lines, f"{role}:{text}")))
    raise AssertionError(best)


def conversations(spark, rows):
    shipped(spark)
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, n int")


def some_turns(draw, conv, n):
    texts = ["Yes.", "No", "  ", "", "Why?  ", "Well!", "a. b", None, "Tell me more."]
    return [(conv, draw.choice([None, *range(n)]), draw.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), draw.choice(texts)) for _ in range(n)]


def ordered(rows):
    clean = [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in rows]
    return sorted(clean, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


@pytest.mark.parametrize("parts", [1, 23])
def test_repair_matches_brute_force(spark, parts):
    """Also with conversations that lie in many parts."""
    draw = random.Random(parts)
    rows = [r for c in range(60) for r in some_turns(draw, c, draw.randint(1, 9))] + some_turns(draw, None, 7) + some_turns(draw, 99, 60)
    rows += rows[:20]  # repeated rows
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r[0]: tuple(r[1:]) for r in turn_repair.report(turn_repair.edits(conversations(spark, rows))).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    by_conv = defaultdict(list)
    for r in rows:
        by_conv[r[0]].append(r)
    assert found == {c: brute_repair(ordered(own)) for c, own in by_conv.items()}


def test_conversation_without_rows_and_many_copies(spark):
    given = conversations(spark, [(1, 0, "user", "Hi."), (2, 0, "user", "Hi."), (3, 0, "user", "Hi.")])
    times = F.when(F.col("conv_id") == 1, 0).when(F.col("conv_id") == 2, 1000).otherwise(1)
    found = {r["conv_id"]: r for r in turn_repair.report(turn_repair.edits(given, times)).collect()}
    assert tuple(found[1])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert (found[2]["duplicate"], found[2]["illegal"], found[2]["audit"]) == (999, 999, "K" + "D" * 999 + "I")
    assert (found[3]["cost"], found[3]["audit"], found[3]["repaired_sha256"]) == (2, "KI", hashlib.sha256(b"user:Hi.\nassistant:").hexdigest())
    assert turn_repair.report(turn_repair.edits(conversations(spark, []))).count() == 0


def test_tables_are_few():
    t = turn_repair.tables()
    assert len(t.vectors) < 20 and t.to.shape == (turn_repair.SYMBOLS**turn_repair.BLOCK, len(t.vectors))


def test_damage_follows_the_checksum(spark):
    rows, times = queries.damaged(conversations(spark, [(c, t, "assistant", "A. B!") for c in range(20) for t in (None, 0, 1)]))
    import zlib

    for r in rows.withColumn("times", times).collect():
        k = zlib.crc32(f"{r['conv_id']}:{' ' if r['turn'] is None else r['turn']}".encode()) % 20
        want = {1: ("assistant", "", 1), 2: ("assistant", "A B", 1), 4: ("user", "A. B!", 1), 0: ("assistant", "A. B!", 0), 3: ("assistant", "A. B!", 2)}
        assert (r["role"], r["text"], r["times"]) == want.get(k, ("assistant", "A. B!", 1))
