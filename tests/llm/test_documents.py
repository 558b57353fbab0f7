"""Operators 3, 4 and 5, and the pipeline."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import corpus
from torque.llm import chat_format as chat
from torque.llm import line_crf, source_mix
from torque.llm.queries import op4_chat_format

SMALL = "/root/testdata/sf0.01"


# ---- line CRF ------------------------------------------------------------------------
def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    sizes = [3, 1, 4, 2]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    node, edge = rng.normal(size=(sum(sizes), 2)), rng.normal(size=(2, 2))
    marginal, pair, total = line_crf.forward_backward(node, edge, bounds)
    pairs = np.zeros((2, 2))
    for d, size in enumerate(sizes):
        weights = {}
        for path in np.ndindex(*(2,) * size):
            s = sum(node[bounds[d] + i, y] for i, y in enumerate(path))
            weights[path] = np.exp(s + sum(edge[a, b] for a, b in zip(path, path[1:])))
        z = sum(weights.values())
        assert np.log(z) == pytest.approx(total[d])
        for i in range(size):
            p = sum(w for path, w in weights.items() if path[i] == 1) / z
            assert marginal[bounds[d] + i, 1] == pytest.approx(p)
        for path, w in weights.items():
            for a, b in zip(path, path[1:]):
                pairs[a, b] += w / z
    assert pair == pytest.approx(pairs)


def test_lines_and_neighbours():
    values = ["", "a\n\nb", "one line", "\n", "x\nx", ""]
    features, chars, bounds = line_crf.line_features(pa.array(values, pa.large_string()))
    assert np.diff(bounds).tolist() == [len(v.split("\n")) for v in values]
    again = line_crf.FEATURES.index("again")
    assert features[:, again].tolist() == [0, 0, 0, 0, 0, 0, 0, 0, 1, 0]
    wide = line_crf.with_neighbours(features, bounds)
    n = len(line_crf.FEATURES)
    assert (wide[1, n:2 * n] == 0).all() and (wide[2, n:2 * n] == features[1]).all()
    assert (wide[3, 2 * n:3 * n] == 0).all() and (wide[2, 2 * n:3 * n] == features[3]).all()


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = line_crf.train(docs, labels)
    again = line_crf.train(docs.repartition(5), labels.repartition(3))
    assert np.allclose(model.weight, again.weight) and model.slope == pytest.approx(again.slope)
    rows = line_crf.score(docs, model).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % line_crf.FOLDS == 0]
    assert len(held) > 40 and all(0 <= r.score <= 1 for r in rows)
    right = sum((r.score >= line_crf.THRESHOLD) == bool(r.quality) for r in held)
    assert right / len(held) > 0.95
    lost = sum(r.score < line_crf.THRESHOLD and r.quality == 1 for r in held)
    assert lost / len(held) < 0.03


def test_classifier_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (None, 1, 0), (77, None, 0)],
                                   "doc_id bigint, quality int, toxic int")
    docs = corpus.odd_documents(spark)
    model = line_crf.train(docs, labels)
    out = line_crf.score(docs, model)
    assert out.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert all(0 <= r.score <= 1 for r in out.collect()) and out.count() == 8
    blank = line_crf.train(corpus.nothing(spark), labels)
    assert line_crf.score(corpus.nothing(spark), blank).count() == 0
    assert {r.score for r in line_crf.score(docs, blank).collect()} == {0.5}


# ---- chat formatting --------------------------------------------------------------------
PIECES = st.sampled_from(chat.CONTROLS + ["\\", "\\\\", "<", "|", ">", "[", "a", "é", "\n", ""])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=12).map("".join))
def test_escape_is_reversible_and_hides_controls(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROLS)


def test_spans_and_rewriting_templates():
    turns = [("user", "hi"), ("assistant", "yo"), ("user", "more")]
    made = chat.render(chat.tagged, turns)
    assert not made.rewrites and [chat.read_back(made.text, s)[:2] for s in made.spans] == turns
    assert chat.render(chat.tagged, []).text == ""

    def forgetful(history):            # older assistant turns lose their text
        return "".join(f"[{r}:{'' if r == 'assistant' and i < len(history) - 1 else t}]"
                       for i, (r, t) in enumerate(history))

    made = chat.render(forgetful, turns)
    assert made.rewrites and made.text == "[user:hi][assistant:][user:more]"
    assert all(0 <= a <= b <= len(made.text) for a, b in made.spans)
    framed = chat.render(lambda h: "<s>" + chat.tagged(h), turns)
    assert not framed.rewrites and framed.spans[0][0] == 3


def test_conversations_by_brute_force(spark):
    got = {r.conv_id: r for r in op4_chat_format(spark, SMALL).collect()}
    by_conv: dict = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    for r in table.orderBy("conv_id", "turn").collect():
        by_conv.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert set(got) == set(by_conv)
    for i, turns in by_conv.items():
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[i].n_turns, got[i].loss_chars) == (len(turns), len(loss))
        assert got[i].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[i].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert not got[i].rewrites_history


def test_conversation_odd_rows(spark):
    schema = "conv_id bigint, turn int, role string, text string, turns int, formatted string"
    rows = [(1, 1, "assistant", None, 0, "x"), (1, 0, None, "hi", 0, "x"), (1, 0, None, "hi", 0, "x"),
            (None, None, "user", "lost", 0, "x"), (2, 0, "assistant", "é" * 9000, 0, "x")]
    got = {r.conv_id: r for r in chat.format_conversations(
        spark.createDataFrame(rows, schema)).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 0 and got[1].loss_spans != []
    assert got[None].n_turns == 1 and got[2].loss_chars == 9000
    a, b = got[2].loss_spans[0]
    assert chat.unescape(got[2].formatted[a:b]) == "é" * 9000
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


# ---- source mix ---------------------------------------------------------------------------
@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 6), st.integers(1, 5)), min_size=1, max_size=12))
def test_targets_share_everything_below_the_caps(pairs):
    sizes, weights = [p[0] for p in pairs], [p[1] for p in pairs]
    got = source_mix.targets(sizes, weights)
    assert sum(got) == sum(sizes)
    assert all(g <= 3 * s for g, s in zip(got, sizes))
    free = {g / w for g, s, w in zip(got, sizes, weights) if s and g < 3 * s}
    assert len(free) <= 1                      # uncapped sources share by weight
    assert all(Fraction(3 * s, w) <= min(free) for g, s, w in zip(got, sizes, weights)
               if free and s and g == 3 * s)


def test_shard_draws_use_every_slot_once():
    slots = (1000, 0, 37, 5, 400)
    n, draw = source_mix.shard_draws(slots, 64, seed=3)
    spans = {s: [] for s in range(len(slots))}
    for shard in range(n):
        first, counts = draw(shard)
        assert counts.sum() == (64 if shard < n - 1 else sum(slots) - 64 * (n - 1))
        for s in range(len(slots)):
            spans[s] += range(first[s], first[s] + counts[s])
    assert all(v == list(range(slots[s])) for s, v in spans.items())
    _, twin = source_mix.shard_draws(slots, 64, seed=3)
    assert (twin(5)[1] == draw(5)[1]).all()


def test_shard_draws_of_huge_counts():
    slots = (3_000_000_000, 1_000_000_001, 7)
    n, draw = source_mix.shard_draws(slots, 1_000_000, seed=1)
    for shard in (0, n // 2, n - 1):
        first, counts = draw(shard)
        assert counts.sum() == min((shard + 1) * 1_000_000, sum(slots)) - shard * 1_000_000
        assert (first >= 0).all() and (first + counts <= np.array(slots)).all()


def test_draws_are_hypergeometric():
    """Mean and variance of a draw without replacement."""
    counts, take = np.array([600, 300, 100]), 400
    got = np.array([source_mix.drawn(np.random.default_rng([9, i]), counts, take)
                    for i in range(4000)])
    assert (got.sum(axis=1) == take).all() and (got >= 0).all() and (got <= counts).all()
    share = counts / 1000
    assert got.mean(axis=0) == pytest.approx(take * share, rel=0.01)
    assert got.var(axis=0) == pytest.approx(take * share * (1 - share) * 600 / 999, rel=0.1)


def test_huge_draws_vary_with_the_seed():
    slots = (3_000_000_000, 1_000_000_001, 7)
    half = [source_mix.drawn(np.random.default_rng(i), np.array(slots), 2_000_000_004)
            for i in range(20)]
    spread = np.std([h[0] for h in half])
    assert 9_000 < spread < 23_000 and all(h.sum() == 2_000_000_004 for h in half)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 700), st.integers(0, 2100), st.integers(1, 40), st.integers(0, 5))
def test_last_slots_meet_the_goal_to_the_word(size, goal, block, source):
    goal = min(goal, 3 * size)
    slots, skip, most = source_mix._last_slot(source, size, goal, block, seed=2)
    blocks, words = -(-size // block), 0
    for j in range(slots):
        turn = np.array([j // blocks])
        b = source_mix.permuted(np.array([j % blocks]), blocks,
                                source_mix.pass_keys(2, source, turn))[0]
        held = min(block, size - b * block)
        words += most if j == slots - 1 else held
        assert j < slots - 1 or (0 < most and 0 <= skip <= held - most)
    assert words == goal


def test_a_thousand_small_sources_meet_their_targets(spark):
    rows = [(s * 2 + h, " ".join(f"w{s}x{h}x{i}" for i in range(20)), f"s{s:04d}")
            for s in range(1000) for h in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mix = source_mix.mix_sources(docs)
    by_source = mix.report().groupBy((F.col("doc_id") / 2).cast("int").alias("s")).agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 1 for r in by_source)
    words = mix.documents().select(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert words == sum(r["taken"] for r in by_source)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutations(n):
    seen = set()
    for key in range(4):
        p = source_mix.permuted(np.arange(n), n, np.full(n, key, np.uint64))
        assert sorted(p.tolist()) == list(range(n))
        back = source_mix.place_of(p, n, np.full(n, key, np.uint64))
        assert back.tolist() == list(range(n))
        seen.add(tuple(p.tolist()))
    assert n < 17 or len(seen) == 4


def check_mix(docs, report):
    sizes = {}
    for r in docs.collect():
        sizes[r.doc_id] = (r.source, len(corpus.words(r.text)))
    got = {r.doc_id: r for r in report.collect()}
    assert set(got) == set(sizes)
    names = sorted({s for s, _ in sizes.values()}, key=lambda s: (s is None, s or ""))
    total = [sum(n for s, n in sizes.values() if s == name) for name in names]
    goal = dict(zip(names, source_mix.targets(total, [1 + i % 3 for i in range(len(names))])))
    for i, (source, n) in sizes.items():
        assert got[i].size == n and got[i].taken <= 3 * n
        assert got[i].target == pytest.approx(float(goal[source]))
        assert got[i].source_size == total[names.index(source)]
    for name in names:
        taken = sum(got[i].taken for i, (s, _) in sizes.items() if s == name)
        assert abs(taken - goal[name]) <= 1


def test_mix_reaches_its_targets(spark):
    docs = corpus.documents(spark)
    check_mix(docs, source_mix.mix_sources(docs, block_words=16, shard_slots=50).report())
    one = source_mix.mix_sources(docs, 16, 50, seed=5).report().collect()
    two = source_mix.mix_sources(docs.repartition(7), 16, 50, seed=5).report().collect()
    assert sorted(one) == sorted(two)


def test_mixed_texts_are_the_taken_words(spark):
    docs = corpus.documents(spark)
    mix = source_mix.mix_sources(docs, 16, 50)
    taken = {r.doc_id: r.taken for r in mix.report().collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = mix.documents()
    assert out.columns == docs.columns
    sizes: dict = {}
    for r in out.collect():
        w, own = corpus.words(r.text), corpus.words(texts[r.doc_id])
        assert r.n_chars == len(r.text) and set(w) <= set(own)
        assert len(w) < len(own) or r.text == texts[r.doc_id]
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + len(w)
    assert sizes == {i: n for i, n in taken.items() if n}


def test_mix_odd_rows(spark):
    docs = corpus.odd_documents(spark)
    mix = source_mix.mix_sources(docs, 4, 10)
    rows = mix.report().collect()
    assert len(rows) == 8
    assert sum(r.taken for r in rows) > 0 and all(r.taken <= 3 * r.size for r in rows)
    assert mix.documents().columns == docs.columns and mix.documents().count() > 0
    empty = source_mix.mix_sources(corpus.nothing(spark))
    assert empty.report().count() == 0 and empty.documents().count() == 0


# ---- pipeline ---------------------------------------------------------------------------------
def test_stages_by_brute_force(spark, tmp_path):
    """Each stage on what the one before kept."""
    labels = spark.createDataFrame([(i, int("!!" not in (t or "")), 0)
                                    for i, t, *_ in corpus.rows(corpus.texts(n=160))],
                                   "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = corpus.documents(spark, corpus.texts(n=160))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [n for n, _ in corpus_pipeline.STAGES] and len(stages) == 5

    def step(name, before):
        out = stages[name](spark, before, str(tmp_path))
        path = f"{tmp_path}/{name.replace(' ', '_')}.parquet"
        out.write.parquet(path)
        return spark.read.parquet(path)

    good = step("quality classifier", docs)
    assert good.columns == docs.columns
    left, all_rows = good.collect(), {r.doc_id: r for r in docs.collect()}
    assert all(all_rows[r.doc_id] == r for r in left)
    junk = [r for r in left if "!!" in (r.text or "")]
    assert len(junk) < 3 and len(left) > 120

    kept = step("n-gram jaccard join", good)
    want = brute = {}
    from tests.llm.test_joins import brute_components, brute_cut
    values = [(r.doc_id, r.text) for r in left]
    brute = brute_components(values, 5, 80)
    want = {i for i, root in brute.items() if i == root}
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == docs.columns

    cut = step("substring dedup", kept)
    values = [(r.doc_id, r.text) for r in kept.collect()]
    by_id = {r.doc_id: r for r in kept.collect()}
    expect = {}
    for i, (n, gone, text) in brute_cut(values, 13).items():
        if gone == 0:
            expect[i] = (by_id[i].text, by_id[i].n_chars)
        elif gone < n:
            expect[i] = (text, len(text))
    assert {r.doc_id: (r.text, r.n_chars) for r in cut.collect()} == expect
    assert cut.columns == docs.columns

    mixed = step("source mix", cut)
    assert mixed.columns == docs.columns
    own = {r.doc_id: corpus.words(r.text) for r in cut.collect()}
    count: dict = {}
    for r in mixed.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + len(corpus.words(r.text))
    assert all(0 < n <= 3 * len(own[i]) for i, n in count.items())

    ids = step("sentencepiece codec", mixed)
    assert ids.count() == mixed.count()
    assert ids.filter("NOT round_trip").count() == 0


def test_pipeline_runs_on_given_tables_and_on_none(spark, tmp_path):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and out.filter("NOT round_trip").count() == 0
    corpus.nothing(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_take_odd_rows(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    docs = corpus.odd_documents(spark).withColumn("lang", F.lit("en")).withColumn(
        "n_chars", F.char_length("text").cast("bigint"))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert out.count() > 0, name


def test_one_row_of_each_component_stays(spark):
    odd = corpus.odd_documents(spark)
    want = [(1, "x"), (1, "y"), (2, "y"), (2, None), (9, "x"), (None, "x"), (None, None)]
    key = lambda r: [(x is None, x or 0) for x in r[:1]] + [r[1] or ""]
    got = [(r.doc_id, r.source) for r in corpus_pipeline.keep_one_of_a_kind(spark, odd, "").collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(1, a), (2, a + " end"), (2, b), (3, c), (3, c), (3, c + " end"), (4, b), (4, ""),
            (4, ""), (None, a), (None, a)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.keep_one_of_a_kind(spark, df, "").collect()
    near = [r.text for r in kept if r.doc_id == 3]
    assert len(near) == 1 and near[0] in (c, c + " end")
    assert sorted((r.doc_id or 0, r.text) for r in kept if r.doc_id != 3) == sorted(
        [(1, a), (2, b), (4, ""), (4, ""), (0, a), (0, a)])
