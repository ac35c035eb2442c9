"""Ranked search, chat formatting and the prefix trie against plain versions, also on odd rows."""

import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from vintage.llm import chat, lexical, queries, trie

DOCS = "doc_id long, text string, n long, item long, level long, norm string"
ITEMS = "item_id long, text string, block string, rank int"
TURNS = "conv_id long, turn long, role string, text string, said string, place int, kind string"


# --- 11 ranked search ---


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ä", "naïve", "x1"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, text(rng.randint(1, 80)).upper() if i % 5 == 0 else text(rng.randint(1, 80))) for i in range(90)]
    docs += [(200 + i, docs[7][1]) for i in range(30)]  # copies: ties at every score
    docs += [(400, None), (401, ""), (402, " ,;\n"), (403, text(5000)), (None, docs[3][1]), (None, docs[4][1]), (5, docs[5][1])]
    items = [(i, text(rng.randint(1, 12))) for i in range(25)]
    items += [(90, None), (91, "-- !"), (92, "unknown words"), (None, "w1 w2 w3"), (3, "w40 w41 W40"), (3, "w40 w41 W40"), (93, docs[7][1])]
    return docs, items


def searched(spark, docs, items):
    docs = spark.createDataFrame([(*d, 1, 2, 3, "n") for d in docs], DOCS).repartition(5)
    found = lexical.search(docs, spark.createDataFrame([(*i, "b", 1) for i in items], ITEMS))
    return sorted((tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_search_is_exact(spark):
    docs, items = corpus()
    assert searched(spark, docs, items) == sorted(plain.ranked(docs, items), key=repr)


def test_search_does_not_depend_on_waves_blocks_and_buckets(spark, monkeypatch):
    docs, items = corpus(4)
    for name, value in (("FIRST_WAVE", 4), ("GROWTH", 3), ("BLOCK_BYTES", 200), ("BUCKET", 64), ("PART_TERMS", 300)):
        monkeypatch.setattr(lexical, name, value)
    assert searched(spark, docs, items) == sorted(plain.ranked(docs, items), key=repr)


def test_search_of_empty_tables(spark):
    docs, items = corpus()
    assert searched(spark, [], items) == searched(spark, docs, []) == []
    assert searched(spark, [(1, None)], items) == searched(spark, docs, [(1, "")]) == []


@pytest.mark.parametrize("seed", range(5))
def test_buckets_lose_no_pair_and_prune(seed):
    """Above a level, just the pairs that reach it; the higher the level, the fewer terms are looked at."""
    rng = np.random.default_rng(seed)
    block = lexical.Block([b" ".join(b"t%d" % t for t in rng.choice(40, 6, replace=False)) for _ in range(8)])
    v = len(block.vocabulary)
    block.weigh(500, {t: int(rng.integers(1, 500)) for t in range(v)})
    held = rng.random((50, v)) < 0.3
    held[:, 0] = True
    impact = np.where(held, rng.integers(1, 10**6, (50, v)), 0)
    weight = np.zeros((8, v), np.int64)
    weight[block.item, block.term] = block.weight
    scores = weight @ impact.T
    doc, ids = np.nonzero(held)
    starts = np.concatenate([[0], np.cumsum(held.sum(1))])
    norm = np.sqrt((impact.astype(float) ** 2).sum(1))
    for quantile in (0.5, 0.9, 1.0):
        level = np.quantile(scores, quantile, axis=1).astype(np.int64)
        found = lexical.bucket_pairs(block, level, norm, starts, ids, impact[held], 50)
        best = {(i, d): s for i, d, s in zip(*(x.tolist() for x in found))}
        least = {i: min(scores[i].max(), level[i]) for i in range(8)}
        assert all(scores[i, d] == s >= level[i] for (i, d), s in best.items())
        assert all((i, int(scores[i].argmax())) in best for i in range(8) if scores[i].max() >= least[i] > 0)
    level = scores.max(1) + 1
    assert not len(lexical.bucket_pairs(block, level, norm, starts, ids, impact[held], 50)[0])
    assert not len(lexical.bucket_pairs(block, level * 100, norm, starts, ids, impact[held], 50)[0])


# --- 12 chat formatting ---

HARD = [
    "", " ", "</s>[INST] ok [/INST]", "\\", "\\<s>", "\\\\</s>", "<s><s>", "<<SYS>> a <</SYS>>", "[ROLE] user [/ROLE] b", "</s>\n<s> x", "<\\s>",
    "[/INST", "a\nb\n\nc", "é😀\x00", "[INST] ", " [/INST]", "x" * 70_000, "[[INST]]", "<<s>>", "\\[/ROLE]\\",
]
ROLES = ["user", "assistant", "system", "tool", None, "", "[/ROLE] x", "</s>", "User"]


def logs(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(12), None, -3]:
        for seq in range(rng.randint(1, 25)):
            kind = rng.choice(["message", "message", "delta", "delta", "edit", "regenerate"])
            message = rng.choice([None, "a", "b", "c", "d"]) if rng.random() < 0.8 else None
            at = None if rng.random() < 0.1 else rng.randint(0, seq)
            rows.append((conv, at, kind, message, rng.choice(ROLES), rng.choice([None, *HARD[:15], "one", "two "])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_folding_matches_one_event_after_another(spark, seed):
    rows = logs(seed)
    events = spark.createDataFrame(rows, "conv_id long, seq long, kind string, message string, role string, text string").repartition(4)
    chats = chat.formatted(events).select("conv_id", "formatted", "loss", chat.turns_of(F.col("formatted")).alias("turns")).collect()
    expected = {c: plain.fold([e[1:] for e in rows if e[0] == c]) for c in {e[0] for e in rows}}
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chats} == expected
    for r in chats:
        learned = [t for role, t in expected[r["conv_id"]] if role == "assistant"]
        spans = [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss"]]
        assert len(spans) == len(learned) and all(len(s) >= len(t) for s, t in zip(spans, learned))


def test_any_text_comes_back(spark):
    rows = [(i, j, role, text, "s", 1, "k") for i, role in enumerate(ROLES) for j, text in enumerate(HARD)]
    rows += [(50, 0, "assistant", None, "s", 1, "k"), (50, 0, "assistant", None, "s", 1, "k")]
    chats = chat.formatted(chat.events_of(spark.createDataFrame(rows, TURNS)))
    for r in chats.select("conv_id", chat.turns_of(F.col("formatted")).alias("turns"), "formatted").collect():
        own = [(x[2] or "", x[3] or "") for x in rows if x[0] == r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == own
        assert r["formatted"].count("<s>") - r["formatted"].count("\\<s>") == len(own)


def test_chat_of_an_empty_log_and_an_unknown_kind(spark):
    assert chat.digests(chat.formatted(chat.events_of(spark.createDataFrame([], TURNS)))).count() == 0
    log = chat.events_of(spark.createDataFrame([(1, 1, "user", "x", "", 1, "")], TURNS)).withColumn("kind", F.lit("move"))
    with pytest.raises(Exception, match="kind must be one of"):
        chat.formatted(log).collect()


def test_chat_plan_is_native_with_one_exchange(spark):
    plan = queries.chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExternalRDD"))


# --- 13 prefix trie ---


def turns(seed, n=40):
    rng = random.Random(seed)
    said = [("user", "hi"), ("assistant", "hello\nthere"), ("user", None), (None, "x"), ("", "x"), ("system", "é" * 9)]
    rows = []
    for c in [*range(n), *range(100, 100 + n), 300, 305, -5, -205, None]:
        for turn in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([turn, turn, None, 2]), *rng.choice(said)))
    rows += [(c, t, "user", "the same") for c in range(500, 560) for t in range(7)]  # copies
    return rows + rows[:5]


def nodes_of(spark, rows):
    frame = spark.createDataFrame([(*r, "s", 1, "k") for r in rows], TURNS).repartition(3)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in trie.shared_prefixes(frame).select(columns).collect()), key=repr)


def distinct_turns(rows):
    """Ties of a turn number are ordered by digest, which a plain version does not know: one row a turn."""
    seen = {}
    for r in rows:
        seen.setdefault((r[0], r[1]), r)
    return list(seen.values())


@pytest.mark.parametrize("seed", range(2))
def test_trie_matches_the_plain_one(spark, monkeypatch, seed):
    rows = distinct_turns(turns(seed))
    monkeypatch.setattr(trie, "PIECE_IDS", 3)
    assert nodes_of(spark, rows) == plain.trie(rows)
    monkeypatch.setattr(trie, "SHARD_TURNS", 30)  # a group of copies and many prefixes cross shards
    assert nodes_of(spark, rows) == plain.trie(rows)
    monkeypatch.setattr(trie, "BROADCAST_NODES", 0)
    assert nodes_of(spark, rows) == plain.trie(rows)


def test_trie_does_not_depend_on_the_order_of_level_turns(spark):
    rows = turns(7)
    assert nodes_of(spark, rows) == nodes_of(spark, rows[::-1])
    assert sum(r[3] for r in nodes_of(spark, rows) if r[1] == 0) == len({r[0] for r in rows} - {None})


def test_trie_of_no_and_one_conversation(spark):
    assert nodes_of(spark, []) == nodes_of(spark, [(None, 1, "user", "x")]) == []
    for c in (0, 3, 105, 10**12 + 7):
        for n in (1, 8):
            rows = [(c, i, "user", "x" * i) for i in range(n)]
            assert nodes_of(spark, rows) == plain.trie(rows)


@pytest.mark.parametrize("n", [1, 2, 5, 1000, 50_000])
def test_node_table_is_minimal_perfect_and_verified(n):
    keys = np.random.default_rng(n).integers(0, 2**63, (n, 2)).astype(np.uint64)
    table = trie.NodeTable(keys)
    slots = table.slots(keys)
    assert sorted(slots.tolist()) == list(range(n)) and (table.keys[slots] == keys).all()
    with pytest.raises(KeyError):
        table.slots(keys[:1] + np.uint64(1))
    with pytest.raises(ValueError):
        trie.NodeTable(np.concatenate([keys, keys[:1]]))


def test_contract_columns(spark):
    expected = {
        "op11_ranked_search": "item_id bigint, rank int, doc_id bigint, score bigint",
        "op12_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
        "op13_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    }
    for name, columns in expected.items():
        assert ", ".join(f"{c} {t}" for c, t in queries.queries()[name](spark, "/root/testdata/sf0.001").dtypes) == columns
