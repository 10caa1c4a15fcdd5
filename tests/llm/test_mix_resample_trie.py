"""Mixing by Pareto order sampling, importance resampling, and the conversation prefix trie."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from casewright.llm import mixing, prefix_trie, resampling

DOCS = "doc_id bigint, text string, source string, size string, _row string, rank int"
TURNS = "conv_id bigint, turn bigint, role string, text string, pos int, node string"
LONG = " ".join(f"w{i % 977}" for i in range(40_000))


def documents(spark, rows):
    return spark.createDataFrame([(*row, "x", "y", 1) for row in rows], DOCS)


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- 11 --------------------------------------------------------------------------------------------------


def shared(sizes, weights, percent, most):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, full = sum(sizes.values()) * percent / 100, {s for s in sizes if sizes[s] == 0}
    while True:
        rest = [s for s in sizes if s not in full]
        left = goal - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] for s in full} | {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = {s for s in rest if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def test_targets_are_shared_until_none_is_above(spark):
    sizes = {"b": 1000, "a": 10, "é": 300, "z": 50, None: 700, "aa": 0, "c": 90}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(shared(sizes, (5, 2, 1), 150, 2))
    assert mixing.source_targets(rows.where("false")).count() == 0
    alone = mixing.source_targets(rows.where("source = 'b'")).first()
    assert alone["target"] == 1500


def test_mix_is_near_its_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i * i % 97), f"s{min(i % 9, 4)}") for i in range(1800)]
    docs = documents(spark, rows)
    first, again = (sorted(mixing.mixed(d).collect()) for d in (docs, docs.repartition(7)))
    assert first == again and [r["doc_id"] for r in first] == list(range(1800))
    taken, target = Counter(), {}
    for r in first:
        assert r["size"] == len(spaced(rows[r["doc_id"]][1])) and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for source, words in taken.items():
        assert abs(words - target[source]) <= max(1, 0.002 * target[source])
    # Certain copies: of a source taken 1.2 times every document is there once at least.
    rate = {s: target[s] / sum(r["size"] for r in first if r["source"] == s) for s in target}
    assert all(r["copies"] in (int(rate[r["source"]]), int(rate[r["source"]]) + 1) for r in first)
    assert any(0 < x < 1 for x in rate.values()) or any(1 < x < 2 for x in rate.values())


def test_mix_takes_the_first_in_pareto_order(spark):
    rows = [(i, "w " * 10, "a" if i < 400 else "b") for i in range(500)]
    got = mixing.mixed(documents(spark, rows), weights=(1, 3), closing=0).collect()
    mine = [r for r in got if r["source"] == "a"]
    rate = mine[0]["target"] / mine[0]["source_size"]
    chance = rate - int(rate)

    def key(r):
        u = (int(hashlib.sha256(f"11:{r['doc_id']}:10".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        return u / (1 - u) * (1 - chance) / chance

    extra = int(chance * 4000 / 10)
    assert {r["doc_id"] for r in mine if r["copies"] > int(rate)} == {r["doc_id"] for r in sorted(mine, key=key)[:extra]}


def test_mix_of_odd_rows(spark):
    rows = [(1, None, None), (None, "a b c", None), (2, "", "s"), (3, LONG, "s"), (3, LONG, "s"), (4, "a a", "s"), (4, "b b", "s"), (5, "x", "ß"), (None, None, "empty")]
    got = mixing.mixed(documents(spark, rows)).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((i, s, len(spaced(t))) for i, t, s in rows)
    assert mixing.mixed(documents(spark, rows).limit(0)).count() == 0
    only = mixing.mixed(documents(spark, [(1, None, "s"), (2, " ", None)])).collect()
    assert all((r["target"], r["taken"]) == (0, 0) for r in only)


def test_mix_of_one_row_repeated_and_expanded(spark):
    rows = [(7, "a b c d", "hot")] * 900 + [(8, "e f", "cold")] * 10
    got = mixing.mixed(documents(spark, rows)).collect()
    hot = [r for r in got if r["source"] == "hot"]
    assert abs(sum(r["taken"] for r in hot) - hot[0]["target"]) <= 0.01 * hot[0]["target"]
    docs = documents(spark, [(i, "w " * (i + 1), "s") for i in range(30)])
    mix = mixing.mixed(docs)
    bag = mixing.expanded(docs, mix)
    assert bag.columns == docs.columns
    assert Counter(r["doc_id"] for r in bag.collect()) == Counter({r["doc_id"]: r["copies"] for r in mix.collect() if r["copies"]})


# --- 12 --------------------------------------------------------------------------------------------------


def grams(text, n, buckets):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [zlib.crc32(" ".join(words[i : i + m]).encode()) % buckets for m in range(1, n + 1) for i in range(len(words) - m + 1)]


def resampled(rows, target, n, buckets, min_words, percent, seed=2024):
    raw, goal = Counter(), Counter()
    for _, t, _ in rows:
        raw.update(grams(t, n, buckets)[1])
    for t in target:
        goal.update(grams(t, n, buckets)[1])
    s_all, t_all = sum(raw.values()), sum(goal.values())
    gain = [math.floor(1000 * math.log((goal[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for i, t, _ in rows:
        words, found = grams(t, n, buckets)
        weight, score = sum(gain[b] for b in found), None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append((i, len(found), weight, score, len(words) >= min_words and i is not None))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0]))
    drawn = able[: percent * len(able) // 100]
    rest = able[len(drawn) :] + [r for r in out if not r[4]]
    return Counter([(*r[:4], k + 1) for k, r in enumerate(drawn)] + [(*r[:4], None) for r in rest])


@pytest.mark.parametrize("n,buckets", [(1, 10_000), (3, 257)])
def test_resampling_equals_its_definition(spark, n, buckets):
    line = "The same line, again and AGAIN"
    rows = [(i, f"{line}\n{'x' * (i % 140)} word{i % 13} é{i % 7}\n\n{line} {i}\r\nÀB c-d", "s") for i in range(300)]
    rows += [(300, None, "s"), (301, "", "s"), (302, "\n\n", "s"), (303, LONG + "\n" + LONG, "s"), (None, line * 9, "s"), (304, line, "s"), (304, line, "s")]
    target = ["the same word3 again", None, "é2 é3\nc d", LONG]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resampled(documents(spark, rows), bench, n=n, buckets=buckets, min_words=9, percent=30)
    assert Counter(tuple(r) for r in got.collect()) == resampled(rows, target, n, buckets, 9, 30)


def test_resampling_of_empty_tables(spark):
    some = documents(spark, [(1, "a b c", "s"), (2, "a a a", "s")])
    none = some.limit(0)
    assert resampling.resampled(none, some).count() == 0
    got = resampling.resampled(some, none, min_words=1, percent=50).collect()
    assert Counter(tuple(r) for r in got) == resampled([(1, "a b c", ""), (2, "a a a", "")], [], 1, 10_000, 1, 50)
    assert resampling.drawn(some, spark.createDataFrame(got)).columns == some.columns


def test_crc_of_spans_long_and_short():
    import numpy as np

    parts = [b"", b"a", bytes(range(256)), "ßé漢".encode(), b"x" * 96, b"y" * 97, b"z" * 5000]
    body = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    assert resampling.crc32_of(body, starts, ends).tolist() == [zlib.crc32(p) for p in parts]


# --- 13 --------------------------------------------------------------------------------------------------


def brute(conversations):
    """Nodes of {conv_id: [(role, text), ...]} by definition."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for path in members:
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(members[path]) - 1) * len(path[-1][1]) if path else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(ends[p])) for p, m in members.items()
    )


def key(row):
    return row[1], row[0]


def turns_of(spark, conversations):
    rows = [(c, i, role, text, 1, "x") for c, turns in conversations.items() for i, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, TURNS)


@pytest.mark.parametrize("height", [2, 8])
def test_trie_equals_its_definition(spark, height):
    say = lambda *words: [("user" if i % 2 else "assistant", w) for i, w in enumerate(words)]
    deep = say(*[f"t{i % 3}" * (i % 4) for i in range(37)])
    conversations = {i: deep[: i % 38] + say(*"ab"[: i % 3]) for i in range(120) if deep[: i % 38] + say(*"ab"[: i % 3])}
    conversations |= {5000 + i: say("same", "same", "x") for i in range(40)} | {-3: say("same", "ab"), -4: say("sameab")}
    steps = prefix_trie.numbered(turns_of(spark, conversations))
    bare = {70000: [], 90000: []}
    members = spark.createDataFrame([(c,) for c in [*conversations, *bare]], "conv_id bigint")
    got = prefix_trie.trie(steps, members, height=height).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(conversations | bare), key=key)


def test_trie_with_more_turns_than_a_block(spark):
    long = [("u", f"{i * i % 11}") for i in range(2 * prefix_trie.BLOCK + 70)]
    conversations = {1: long, 2: long[: prefix_trie.BLOCK], 3: long[: prefix_trie.BLOCK + 1] + [("u", "end")], 4: long[1:1100]}
    steps = prefix_trie.numbered(turns_of(spark, conversations))
    members = spark.createDataFrame([(c,) for c in conversations], "conv_id bigint")
    got = prefix_trie.trie(steps, members).collect()
    assert [r[3] for r in sorted(got, key=key) if r["depth"] in (0, prefix_trie.BLOCK, prefix_trie.BLOCK + 1)] == [4, 3, 1, 2, 1]
    # Sums over chains as long as these, by definition in one pass from the leaves.
    count, parent, weight = {}, {}, {}
    marks = {}
    for c, turns in conversations.items():
        node = 0
        count[0] = count.get(0, 0) + 1
        for turn in turns:
            child = marks.setdefault((node, turn), len(marks) + 1)
            parent[child], weight[child] = node, len(turn[1])
            count[child] = count.get(child, 0) + 1
            node = child
    saved = {n: (count[n] - 1) * weight.get(n, 0) for n in count}
    for n in sorted(parent, reverse=True):
        saved[parent[n]] += saved[n]
    assert Counter(r["saved_tokens"] for r in got) == Counter(saved.values())


def test_turns_are_numbered_and_starts_shared(spark):
    rows = [(100, None, None, "first", 1, "x"), (100, 5, "u", None, 1, "x"), (100, 2, "u", "b", 1, "x"), (100, 2, "u", "b", 1, "x"), (None, 1, "u", "lost", 1, "x"),
            (107, 0, "u", "own0", 1, "x"), (107, 1, "u", "own1", 1, "x"), (107, 2, "u", "own2", 1, "x"), (307, 0, "u", "gone", 1, "x")]
    steps = prefix_trie.numbered(spark.createDataFrame(rows, TURNS))
    assert [tuple(r) for r in steps.select("conv_id", "pos", "chars").where("conv_id = 100").orderBy("pos").collect()] == [(100, 1, 5), (100, 2, 1), (100, 3, 1), (100, 4, 0)]
    conv = F.col("conv_id")
    built, members = prefix_trie.with_shared_start(steps, conv - conv % 100, F.lit(2), 5)
    original = {100: [("", "first"), ("u", "b"), ("u", "b"), ("u", "")], 107: [("u", "own0"), ("u", "own1"), ("u", "own2")], 307: [("u", "gone")]}
    shared_start = {c: original.get(c - c % 100, [])[:2] + t[2:] for c, t in original.items()}
    assert shared_start[307] == []
    got = prefix_trie.trie(built, members).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(shared_start), key=key)


def test_trie_of_no_conversations(spark):
    steps = prefix_trie.numbered(spark.createDataFrame([], TURNS))
    built, members = prefix_trie.with_shared_start(steps, F.col("conv_id"), F.lit(3), 5)
    assert prefix_trie.trie(built, members).count() == 0
