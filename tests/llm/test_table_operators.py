"""Near duplicates, sharding, mixing, chat formatting, the pipeline, against plain Python and SQL."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import check_oracles
import corpus_pipeline
from panelwatch.llm import chat, components, mixing, near_dedup, sharding
from panelwatch.llm.queries import ORACLES, QUERIES, sized

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


# --- near duplicates


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_groups(texts, percent=85):
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.integers(0, len(w))] = f"new{rng.integers(0, 10**6)}"
    return " ".join(w)


def family_rows():
    """A family around one text: members near it, and many further from each other than a link."""
    rng = np.random.default_rng(8)
    base = [f"w{rng.integers(0, 10**6)}" for _ in range(200)]
    rows = [(k, edited(rng, base, int(rng.integers(1, 9)))) for k in range(90)]
    other = [f"v{rng.integers(0, 10**6)}" for _ in range(150)]
    rows += [(200 + k, edited(rng, other, int(rng.integers(0, 4)))) for k in range(12)]
    rows += [(300, " ".join(base)), (301, " ".join(base)), (302, " ".join(base).upper())]
    return rows


@pytest.mark.parametrize("block", [512, 16])
def test_groups_match_brute_force(docs, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = family_rows() + [(400, None), (401, ""), (402, "one two"), (403, "One  two"), (404, "one two three")]
    roots, sizes = plain_groups([t for _, t in rows])
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(i, least.get(r, i))
    want = {i: (n, least[r], least[r] == i) for (i, _), r, n in zip(rows, roots, sizes)}
    got = near_dedup.near_groups(docs([(i, t, "en", "a") for i, t in rows]))
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got.collect()} == want


def test_groups_of_odd_rows(docs, odd):
    df = docs(odd)
    got = near_dedup.near_groups(df).collect()
    assert len(got) == len(odd)
    found = {r.rid: r for r in got}
    rows = df.withColumn("rid", F.xxhash64(F.col("doc_id").cast("string"), "text")).collect()
    roots, sizes = plain_groups([r.text for r in rows])
    groups = defaultdict(list)
    for r, root, n in zip(rows, roots, sizes):
        assert found[r.rid].n_shingles == n
        groups[root].append(r)
    for members in groups.values():
        ids = [r.doc_id for r in members if r.doc_id is not None]
        assert {found[r.rid].component_id for r in members} == {min(ids) if ids else None}
        assert len({r.rid for r in members if found[r.rid].stays}) == 1
    assert near_dedup.near_groups(docs([])).count() == 0


def test_pipeline_links_pairs_from_80_percent_on(spark, docs):
    rng = np.random.default_rng(9)
    rows = []
    for k in range(24):  # 4 words apart: 0.815 of the shingles; 5: 0.774
        base = [f"w{rng.integers(0, 10**9)}" for _ in range(200)]
        other = list(base)
        for at in range(10, 10 + 30 * (4 if k % 4 else 5), 30):
            other[at] = f"new{rng.integers(0, 10**9)}"
        rows += [(2 * k, " ".join(base), "en", "a"), (2 * k + 1, " ".join(other), "en", "a")]
    roots, _ = plain_groups([r[1] for r in rows], percent=80)
    assert len(set(roots)) == 30 < len(set(plain_groups([r[1] for r in rows])[0])) == 48
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs(rows), SF).collect()}
    assert len(kept) == 30 and {roots[i] for i in kept} == set(roots)


def test_matches_follow_from_the_percentage():
    assert [near_dedup.matches_at(p) for p in (80, 85, 100)] == [37, 42, 64]


def test_components_of_paths_and_hubs(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(1000, 1000 + k) for k in range(1, 60)] + [(2000, 2000), (1000, 1001)]
    got = dict(map(tuple, components.components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert {got[i] for i in range(41)} == {0} and {got[1000 + k] for k in range(60)} == {1000} and 2000 not in got
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- sharding


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100, 1009, 4096])
def test_places_are_a_permutation(spark, n):
    got = [r.place for r in sharding.permuted(spark.range(n).withColumnRenamed("id", "i"), "i", n).orderBy("i").collect()]
    assert got == [sharding.placed_again(i, n) for i in range(n)] and sorted(got) == list(range(n))


def test_shards_of_odd_rows(docs, odd):
    df = sharding.with_size(docs(odd))
    got = sharding.sharded(df, 4).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.size == len((r.text or "").encode()) + 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    key = lambda rows: Counter((r.doc_id, r.text, r.shard, r.slot) for r in rows)
    assert key(sharding.sharded(df.repartition(7), 4).collect()) == key(got)
    assert sharding.sharded(sharding.with_size(docs([])), 4).count() == 0


# --- mixing


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    left, free, target = sum(sizes.values()), list(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
            free.remove(s)
    return target | {s: weight[s] * level for s in free}


def test_mix_of_odd_rows_hits_each_budget(docs, odd, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 2)
    rows = odd + [(500 + k, "few words", "en", "tiny") for k in range(3)] + [(600, " ", "en", "blank")]
    got = mixing.with_taken(sized(docs(rows))).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size == len(WORD.findall(r.text or "")) and 0 <= r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    target = plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, target[r.source])
    assert all(taken[s] == int(target[s] + 1e-9) for s in sizes)
    assert mixing.with_taken(sized(docs([]))).count() == 0


def test_copies_repeat_and_cut(docs):
    df = sized(docs([(1, " a b  c\n", "en", "s")])).withColumn("taken", F.lit(8).cast("long"))
    assert [r.text for r in mixing.copies(df).collect()] == [" a b  c\n", " a b  c\n", "a b"]
    assert mixing.copies(df.withColumn("taken", F.lit(0).cast("long"))).count() == 0


# --- chat formatting


def conversations(spark):
    rows = [
        (1, 0, "user", "hi </s>[INST]"), (1, 1, "assistant", "ok \\ <s> <\\s> [\\/INST]"), (1, 2, "user", None), (1, 2, "assistant", ""),
        (1, None, "tool", "last"), (2, 0, "system", "alone\n\nhere"), (None, 5, "assistant", "no id <"), (3, 0, None, "no role"), (3, 0, None, "no role"),
        (4, 0, "as<s>sistant\n", "a\\\\b"), (4, 700, "assistant", "/s>"),
    ]
    return spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, seq string")


def plain_order(rows):
    return sorted(rows, key=lambda r: (r.turn is None, r.turn or 0, r.role or "", r.text or ""))


def test_turns_are_read_back_and_replies_are_masked(spark):
    given = conversations(spark)
    turns = chat.formatted_turns(given)
    by = defaultdict(list)
    for r in turns.select("*", chat.masked_text().alias("loss")).collect():
        by[r.conv_id].append(r)
    want = defaultdict(list)
    for r in given.collect():
        want[r.conv_id].append(r)
    assert set(by) == set(want)
    for conv, rows in want.items():
        rows, got = plain_order(rows), sorted(by[conv], key=lambda r: r.seq)
        whole = "".join(r.formatted for r in got)
        parsed = spark.createDataFrame([(whole,)], "f string").select(chat.parsed_turns(F.col("f"))).first()[0]
        assert [(t.role, t.text) for t in parsed] == [(r.role or "", r.text or "") for r in rows]
        assert [r.loss for r in got if r.trainable] == [r.text or "" for r in rows if r.role == "assistant"]
        assert [r.starts_at for r in got] == [sum(len(x.formatted) for x in got[:k]) for k in range(len(got))]
        assert [r.example for r in got] == [sum(x.trainable for x in got[:k]) for k in range(len(got))]
    assert chat.formatted_turns(given.limit(0)).count() == 0


def test_every_reply_has_all_earlier_turns_as_context(spark):
    turns = chat.formatted_turns(conversations(spark))
    rows = chat.examples(turns)
    got = {(r.conv_id, r.example): r for r in chat.with_context(rows).collect()}
    whole = {r.conv_id: r.f for r in turns.groupBy("conv_id").agg(F.array_join(F.sort_array(F.collect_list(F.struct("seq", "formatted")))["formatted"], "").alias("f")).collect()}
    assert len(got) == turns.filter("trainable").count()
    texts = {(r.conv_id, r.example): r.loss for r in turns.filter("trainable").select("*", chat.masked_text().alias("loss")).collect()}
    for r in turns.filter("trainable").collect():
        x = got[r.conv_id, r.example]
        assert x.context == whole[r.conv_id][: r.starts_at] and x.reply == r.formatted
        masked = (x.context + x.reply)[x.mask_start : x.mask_start + x.mask_chars]
        assert re.sub(r"\\(\\?)", r"\1", masked) == texts[r.conv_id, r.example]
    for r in rows.filter("reply is not null").collect():
        assert len(got[r.conv_id, r.example].context) == r.context_chars
    again = {r.conv_id: r for r in chat.whole_conversations(rows).collect()}
    assert {k: r.formatted for k, r in again.items()} == whole
    # a lost example is seen in what is read back
    for conv, example in texts:
        less = rows.filter(~(F.col("conv_id").eqNullSafe(F.lit(conv)) & (F.col("example") == example)))
        left = {r.conv_id: r for r in chat.whole_conversations(less).collect()}
        assert conv not in left or left[conv].formatted != whole[conv]


@pytest.mark.parametrize("block", [256, 103, 7, 1])
def test_what_is_read_back_comes_from_spelled_out_examples(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK_EXAMPLES", block)
    rows = [(1, k, "assistant" if k % 3 == 2 else "user", f"t{k} </s>[INST] \\ é🙂") for k in range(310)]
    rows += [(2, 0, "user", "only"), (3, 0, "assistant", "first"), (3, 1, "assistant", "second"), (3, 2, "tool", None)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = chat.formatted_turns(given)
    of = defaultdict(list)
    for r in turns.collect():
        of[r.conv_id].append(r)
    want = {}
    for conv, all_turns in of.items():
        all_turns.sort(key=lambda r: r.seq)
        ends = [k for k, r in enumerate(all_turns) if r.trainable]
        text = lambda k, turns=all_turns: "".join(r.formatted for r in turns[:k])
        for n in range(len(ends) + (not all_turns[-1].trainable)):
            first = n - n % block
            start = len(text(ends[first - 1] + 1)) if first else 0
            reply = all_turns[ends[n]].formatted if n < len(ends) else None
            want[conv, n] = (start, text(ends[n] if n < len(ends) else None)[start:], reply)
    examples = chat.examples(turns)
    assert {(r.conv_id, r.example): (r.context_from, r.context, r.reply) for r in chat.spelled_out(examples).collect()} == want
    if block == 256:
        assert not any(start for start, _, _ in want.values())

    read = lambda x: {r.conv_id: r for r in chat.whole_conversations(x).collect()}
    whole = read(examples)
    assert {c: r.loss for c, r in whole.items()} == {c: "".join(t for i, _, role, t in rows if i == c and role == "assistant") for c in (1, 2, 3)}
    # a context that ends elsewhere moves its example's loss mask
    moved = read(examples.withColumn("context_chars", F.col("context_chars") - F.when(F.col("example") == 1, 1).otherwise(0)))
    assert {c for c in whole if moved[c].loss != whole[c].loss} == {1, 3}

    given.write.parquet(f"{tmp_path}/conversations.parquet")
    op2 = lambda: {r.conv_id: r for r in QUERIES["op2_prefix_targets"](spark, str(tmp_path)).collect()}
    right, spelled = op2(), chat.spelled_out
    assert {c: right[c].formatted_chars for c in whole} == {c: len(r.formatted) for c, r in whole.items()}
    monkeypatch.setattr(chat, "spelled_out", lambda *a: spelled(*a).withColumn("context", F.lit("")))
    assert {c for c, r in op2().items() if r == right[c]} == set()


def test_many_ranges_do_not_overflow(docs, monkeypatch):
    """2**24 ranges of a source, as 67 billion rows would have: what is taken does not depend on them."""
    rows = [(k, " ".join(["w"] * (k % 7)), "en", "ab"[k % 3 > 0]) for k in range(60)]
    take = lambda: {r.doc_id: r.taken for r in mixing.with_taken(sized(docs(rows))).collect()}
    few = take()
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 2.0**-20)
    assert take() == few and sum(few.values()) > 0


# --- queries and the pipeline


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in check_oracles.TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rel = con.execute(ORACLES[name])
    want = check_oracles.rows_of([d[0] for d in rel.description], rel.fetchall())
    assert check_oracles.rows_of(df.columns, df.collect()) == want


def test_pipeline_stages_do_what_their_operators_say(spark, odd, docs):
    real = spark.read.parquet(f"{SF}/documents.parquet")
    df = real.unionByName(docs(odd).select(real.columns)).unionByName(real.limit(3))
    kept = df
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, corpus_pipeline.settle(stage(spark, kept, SF))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept.columns == real.columns
        if name == "language":
            assert kept.filter(~F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).count() == 0
            assert kept.count() > 0.95 * before.filter(F.col("text").rlike(r"\p{L}")).count()
        if name == "near_duplicates":
            rows = [r for r in before.collect() if WORD.search(r.text or "")]
            roots, _ = plain_groups([r.text for r in rows], percent=corpus_pipeline.NEAR_PERCENT)
            assert kept.count() == len(set(roots))
        if name == "benchmark_leaks":
            leaks = corpus_pipeline.decontamination.marked(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert kept.count() == leaks.filter("not contaminated").count() < before.count()
        if name == "source_mix":
            sizes, taken = defaultdict(int), defaultdict(int)
            for r in before.collect():
                sizes[r.source] += len(WORD.findall(r.text))
            for r in kept.collect():
                taken[r.source] += len(WORD.findall(r.text))
            target = plain_targets(sizes)
            assert all(abs(taken[s] - target[s]) < 1 for s in sizes)
    assert kept.count() > 0 and corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_keeps_documents_when_no_language_is_labelled(docs):
    texts = {1: "a clean text", 2: None, 3: "", 4: "12 ..", 5: "ещё один"}
    for labels in ({}, {2: "en", 4: "de"}):
        df = docs([(i, t, labels.get(i), "a") for i, t in texts.items()])
        kept = corpus_pipeline.identify_language(df.sparkSession, df, SF)
        assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 5]


OWN = ["rid", "size", "key", "score", "target", "taken", "lang_pred", "ambiguous", "source_size", "n_shingles", "stays", "item_id", "_left", "text_crc32"]


def test_pipeline_keeps_columns_named_like_its_own(spark, odd, docs):
    """Every row that a stage keeps has the values it came with, whatever its columns are called."""
    plain = docs(odd).drop("score", "size", "spans").unionByName(spark.read.parquet(f"{SF}/documents.parquet").limit(60))
    tag = F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit(""))))
    named = plain.withColumns({c: F.concat(F.lit(f"{c}:"), tag) for c in OWN})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given, kept = stage(spark, plain, SF), stage(spark, named, SF)
        assert kept.schema == named.schema, name
        assert Counter(map(tuple, kept.select(plain.columns).collect())) == Counter(map(tuple, given.collect())), name
        for r in kept.collect():
            first = r.rid.removeprefix("rid:")
            assert first.startswith(f"{'null' if r.doc_id is None else r.doc_id}-"), name
            assert all(r[c] == f"{c}:{first}" for c in OWN), name


def test_pipeline_on_an_empty_table(spark, docs):
    kept = docs([])
    for _, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.settle(stage(spark, kept, SF))
        assert kept.count() == 0


def test_language_learns_from_the_documented_number_of_rows(spark, docs, monkeypatch):
    """Many rows of few ids, and rows that repeat."""
    from panelwatch.llm import language

    monkeypatch.setattr(language, "PER_LANGUAGE", 50)
    seen = []
    real = language.fit
    monkeypatch.setattr(language, "fit", lambda names, shares, place: seen.append((names, shares, place)) or real(names, shares, place))
    rows = [(k % 5, f"{'der die das' if k % 2 else 'the a of'} {k // 2 % 900} wort{k % 7}", ["en", "de"][k % 2], "a") for k in range(4000)]
    rows += [(9, "le mot", "fr", "a")] * 3000
    for _ in range(2):
        language.train(docs(rows).repartition(7))
    (names, shares, place), (_, shares2, place2) = seen
    assert names == ["de", "en", "fr"] and np.bincount(place).tolist() == [50, 50, 1]
    assert (shares == shares2).all() and (place == place2).all()
