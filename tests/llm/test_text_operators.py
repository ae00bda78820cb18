"""Operators on texts against plain Python, with odd rows, repeated rows and empty tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwatch.llm import decontamination, language, packing, quality, scan, suffix_dedup, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_row(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# --- repeated byte strings


def spans_of(texts, window):
    raw = [(t or "").encode() for t in texts]
    met = Counter(b[i : i + window] for b in raw for i in range(len(b) - window + 1))
    out = []
    for b in raw:
        hit = [False] * len(b)
        for i in range(len(b) - window + 1):
            if met[b[i : i + window]] > 1:
                hit[i : i + window] = [True] * window
        edges = [i for i in range(len(b) + 1) if (i < len(b) and hit[i]) != (i > 0 and hit[i - 1])]
        kept = bytes(c for c, h in zip(b, hit) if not h)
        out.append((list(zip(edges[::2], edges[1::2])), kept))
    return out


@pytest.mark.parametrize("options", [{}, {"shard_passages": 2}, {"often": 3}, {"often": 1, "shard_passages": 1}])
def test_repeated_spans_match_brute_force(docs, odd, options):
    rng = np.random.default_rng(3)
    letters = lambda n: "".join(rng.choice(list("ab"), n))
    common = letters(260)
    rows = odd + [(100 + k, letters(rng.integers(0, 40)) + common[rng.integers(0, 50) : rng.integers(210, 260)] + letters(60), "en", "a") for k in range(25)]
    df = docs(rows)
    got = suffix_dedup.repeated_spans(df, **options)
    assert set(df.columns) <= set(got.columns)
    got = got.select("doc_id", "text", F.col("spans"), suffix_dedup.kept_bytes().alias("kept")).collect()
    want = Counter((i, t, str(s), bytes(k)) for (i, t, _, _), (s, k) in zip(rows, spans_of([r[1] for r in rows], 200)))
    assert Counter((r.doc_id, r.text, str([(s.start, s.end) for s in r.spans]), bytes(r.kept)) for r in got) == want


def test_monotone_text_has_a_bounded_number_of_passages(docs):
    texts = ["-" * 300_000, "abcde" * 9_000 + "end of it", "-" * 200, "x" * 199, "-" * 199 + "y", "tail " + "-" * 201 + " then abcde", "abcde" * 41]
    keyed = docs([(i, t, None, None) for i, t in enumerate(texts)])
    rows = keyed.selectExpr("doc_id AS rid", "0L AS tag", "text").mapInArrow(suffix_dedup.anchor_runs(200), suffix_dedup._RUNS)
    assert rows.filter("key IS NOT NULL").count() < 1_500 and rows.count() < 3_000
    for options in ({}, {"shard_passages": 2, "often": 3}):
        got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in suffix_dedup.repeated_spans(keyed, **options).collect()}
        assert got == {i: spans for i, (spans, _) in enumerate(spans_of(texts, 200))}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.binary(min_size=1, max_size=6), st.integers(1, 60)), min_size=1, max_size=8))
def test_folded_runs_cover_what_they_leave_out(parts):
    data = np.frombuffer(b"".join(p * n for p, n in parts).ljust(60, b"."), np.uint8)
    found = suffix_dedup.passages(data, np.array([0, len(data)]), 50, scan.Powers())
    keep, at, count = suffix_dedup.fold_runs(*found)
    raw, windows = data.tobytes(), [data[i : i + 50].tobytes() for i in range(len(data) - 49)]
    covered = {w for a, b in zip(found[2][keep], found[3][keep]) for w in range(a, b)}
    folded = [w for a, n in zip(at, count) for w in range(a, a + n)]
    assert len(folded) == len(set(folded)) and not covered & set(folded) and covered | set(folded) == set(range(len(windows)))
    assert all(raw.count(windows[w]) > 0 and sum(windows[c] == windows[w] for c in covered) >= 2 for w in folded)


def test_repeated_spans_of_nothing(docs):
    assert suffix_dedup.repeated_spans(docs([])).count() == 0


def test_suffix_array_is_sorted_and_prefixes_are_right():
    texts = [b"banana banana", b"ananas", b"banana", b"aaaaaaaaaaaaaaaaaaaa", bytes(range(200))]
    sizes = np.array([len(t) + 1 for t in texts])
    data = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    end = np.repeat(np.cumsum(sizes) - 1, sizes)
    order, rank, eight = suffix_dedup.suffix_array(data, end)
    suffix = lambda p: data[p : end[p]].tobytes()
    keys = [(suffix(p) + b"\xff", int(end[p])) for p in order]
    assert keys == sorted(keys) and (order[rank] == np.arange(len(data))).all()
    before, value = suffix_dedup.common_prefixes(data, end, order, eight)
    for p in range(len(data)):
        if before[p] >= 0:
            a, b = suffix(p), suffix(int(before[p]))
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert value[p] == n


# --- quality


def base_of(text):
    w = WORD.findall(text or "")
    met, hit = Counter(zip(w, w[1:], w[2:])), [0] * len(w)
    for i in range(len(w) - 2):
        if met[tuple(w[i : i + 3])] > 1:
            hit[i] = hit[i + 1] = hit[i + 2] = 1
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), sum(hit)


def test_statistics_and_base_rules(docs, odd, spark):
    df = docs(odd)
    labels = spark.createDataFrame([(5, 1), (12, 0), (12, None), (None, 1)], "doc_id long, quality int")
    got = quality.judged(df, labels).select("doc_id", *quality.BASE, "base_failed").collect()
    want = Counter()
    for i, t, _, _ in odd:
        b = base_of(t)
        want[(i, *b, b[0] < 50 or 100 * b[4] > 50 * b[0])] += 1
    assert Counter(map(tuple, got)) == want
    assert quality.judged(docs([]), labels).count() == 0
    assert quality.judged(df, labels.limit(0)).filter("kept = base_failed").count() == 0


def test_trees_are_monotone_and_learn():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality.FEATURES)))
    f = quality.FEATURES.index("symbol_share")
    y = ((x[:, f] < 0.6) & (rng.random(3000) < 0.9) | (x[:, 0] > 0.9)).astype(float)
    model = quality.fit(x, y)
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.85
    for name, sign in quality.MONOTONE.items():
        k, line = quality.FEATURES.index(name), np.repeat(x[:40], 50, axis=0)
        line[:, k] = np.tile(np.linspace(-0.1, 1.1, 50), 40)
        steps = np.diff(model.score(line).reshape(40, 50), axis=1)
        assert sign == 0 or (sign * steps >= -1e-12).all()
    one = model.score(x[:1])
    assert np.isclose(model.score(x)[0], one[0])


# --- language


def test_codes_keep_languages_apart():
    for n in (1, 2, 4, 6, 9, 40):
        code = language.codewords(n)
        assert code.shape[0] == n and len({tuple(c) for c in code}) == n
    a = language.codewords(4)
    assert min((a[i] != a[j]).sum() for i in range(4) for j in range(i)) == 4


def test_language_of_odd_rows(docs, odd):
    en, de = "the cat of the house and ", "der hund und das haus die "
    rows = [(k, (en if k % 2 else de) * 5, "en" if k % 2 else "de", "s") for k in range(40)]
    model = language.train(docs(rows))
    got = language.with_language(docs(rows + odd), model)
    assert got.columns.count("score") == 1
    ids = {r.doc_id: r for r in got.filter("source = 's'").collect()}
    assert all(ids[k].lang_pred == ("en" if k % 2 else "de") for k in range(16, 40))
    for r in got.collect():
        has = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not has) and 0 <= r.score <= 1
    assert got.count() == len(rows) + len(odd)
    assert language.with_language(docs([]), model).count() == 0
    assert language.train(docs([(1, "x", None, "s")])) is None
    assert language.with_language(docs(odd), None).filter("lang_pred != 'und'").count() == 0


def test_training_rows_are_those_with_a_letter(docs, monkeypatch):
    """A language whose rows mostly have no usable text brings all those that are usable."""
    monkeypatch.setattr(language, "fit", lambda languages, shares, which: Counter(languages[k] for k in which))
    rows = [(k, "the cat", "en", "s") for k in range(30)] + [(1000 + k, None if k % 2 else "12 ..", "de", "s") for k in range(4000)]
    rows += [(9000 + k, "der hund", "de", "s") for k in range(20)] + [(9500, "", "fr", "s"), (9501, None, "fr", "s")]
    assert language.train(docs(rows)) == {"en": 30, "de": 20}
    assert language.train(docs(rows[-2:])) is None


# --- token counts and packing

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_token_counts_match_the_library(docs, odd):
    import sentencepiece

    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    more = ["a  b", " a", "a ", "  ", "\n", "\n\n a\n", "▁  x", "<s> </s>", "é①ﬁ\t\r\n", "\x00 \x00", "the " * 500]
    rows = odd + [(200 + k, t, "en", "a") for k, t in enumerate(more)]
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = Counter(map(tuple, token_counts.with_token_counts(docs(rows), path).collect()))
    assert got == Counter((i, len((t or "").encode()), len(model.encode(t or ""))) for i, t, _, _ in rows)
    assert token_counts.with_token_counts(docs([]), path).count() == 0


@pytest.mark.parametrize("row, block", [(64, 1000), (2048, 1 << 20)])
def test_packed_rows_give_the_texts_back(docs, row, block):
    texts = ["", "one", "two words", "x" * 5000, "zażółć 🙂 " * 300, "two words", "\n\n  \n"] + [f"text {k} " * k for k in range(60)]
    df = docs([(k, t, "en", "a") for k, t in enumerate(texts)] + [(900, None, "en", "a")])
    path = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = [r.asDict() for r in packing.packed_rows(df, path, public_tokenizers.PATTERN, 50256, row=row, block_tokens=block).collect()]
    back = packing.texts_back(rows, path, public_tokenizers.PATTERN)
    assert all(back.get(k, "") == t for k, t in enumerate(texts)) and 900 not in back
    for r in rows:
        cuts, ids, places = r["cu_seqlens"], np.frombuffer(r["input_ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2")
        assert len(ids) == row and cuts[0] == 0 and cuts[-1] == r["n_tokens"] <= row and len(cuts) == len(r["doc_ids"]) + 1
        assert all((places[a:z] == np.arange(z - a)).all() for a, z in zip(cuts, cuts[1:])) and (ids[cuts[-1] :] == 50256).all()
    assert packing.packed_rows(docs([]), path, public_tokenizers.PATTERN, 50256).count() == 0


def test_best_fit_matches_a_plain_search():
    rng = np.random.default_rng(2)
    for row in (7, 64, 100):
        sizes = rng.integers(1, row + 1, 500)
        rooms = []
        for s in sorted(sizes, reverse=True):
            fits = [r for r in rooms if r >= s]
            if fits:
                rooms[rooms.index(min(fits))] -= s
            else:
                rooms.append(row - s)
        packed = packing.best_fit(sizes, row)
        assert sorted(i for p in packed for i in p) == list(range(500))
        assert sorted(row - sizes[p].sum() for p in packed) == sorted(rooms)


# --- decontamination


def plain_tiles(text, item, least):
    t_free, p_free, tiles = [True] * len(text), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for t in range(len(text)):
            for p in range(len(item)):
                k = 0
                while t + k < len(text) and p + k < len(item) and t_free[t + k] and p_free[p + k] and text[t + k] == item[p + k]:
                    k += 1
                if k > best[2]:
                    best = (t, p, k)
        t, p, k = best
        if k < least:
            return tiles
        t_free[t : t + k] = p_free[p : p + k] = [False] * k
        tiles.append(best)


def test_tiles_match_the_plain_algorithm():
    rng = np.random.default_rng(4)
    for _ in range(150):
        item = rng.integers(0, 6, rng.integers(3, 25)).astype(np.uint64)
        text = rng.integers(0, 6, rng.integers(3, 60)).astype(np.uint64)
        if rng.random() < 0.6:
            cut = int(rng.integers(0, len(item)))
            text = np.concatenate([text, item[cut:], text[:3], item[:cut]])
        got = decontamination.tile(text, item, 3, scan.Powers())
        want = plain_tiles(text.tolist(), item.tolist(), 3)
        assert [k for _, _, k in got][:1] == [k for _, _, k in want][:1]
        assert all((text[t : t + k] == item[p : p + k]).all() for t, p, k in got)
        used = [i for _, p, k in got for i in range(p, p + k)]
        assert len(used) == len(set(used)) and not plain_left(text, item, got, 3)


def plain_left(text, item, tiles, least):
    """Whether a match of ``least`` free tokens is left."""
    t_free, p_free = [True] * len(text), [True] * len(item)
    for t, p, k in tiles:
        t_free[t : t + k] = p_free[p : p + k] = [False] * k
    return any(
        all(t_free[t : t + least]) and all(p_free[p : p + least]) and (text[t : t + least] == item[p : p + least]).all()
        for t in range(len(text) - least + 1)
        for p in range(len(item) - least + 1)
    )


def test_contaminated_documents_are_found(docs, odd, spark, monkeypatch):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    parts = item.split()
    moved = " ".join(parts[6:] + ["and", "then"] + parts[:6])
    rows = odd + [(50, "x y " + item.upper().replace(" ", ", ") + " z", "en", "a"), (51, moved, "en", "a"), (52, " ".join(parts[:5]) + " other", "en", "a")]
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short"), (5, item), (6, "nothing like it is anywhere to be found")], "item_id long, text string")
    df = docs(rows).withColumn("coverage", F.lit("own"))
    got = decontamination.marked(df, items)
    hit = {r.doc_id: r for r in got.filter("contaminated").collect()}
    assert set(hit) == {50, 51} and hit[50].item_id == 1 and hit[50].coverage == 1.0
    assert sorted(t.length for t in hit[51].tiles) == [6, 6]
    assert got.count() == len(rows)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 40)
    again = decontamination.marked(df, items)
    assert by_row(again.filter("contaminated"), "doc_id", "item_id") == [(50, 1), (51, 1)]
    assert decontamination.marked(docs([]), items).count() == 0
    assert decontamination.marked(df, items.limit(0)).filter("contaminated").count() == 0


def test_tokens_of_scripts_without_spaces():
    powers = scan.Powers()

    def counted(*texts):
        raw = [t.encode() for t in texts]
        words, firsts = decontamination.tokens(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])), powers)
        return [words[a:b].tolist() for a, b in zip(firsts, firsts[1:])]

    got = counted("中国的首都是北京。", "中国、的首都（是）北京", "ภาษาไทย", "カタカナ・かな", "Москва—столица “России”", "naïve über 한국어 문장", "𠀀𠀁 ab𠀀", "中", "")
    assert [len(w) for w in got] == [8, 8, 7, 6, 3, 4, 4, 1, 0]
    assert got[0] == got[1] and got[7] == got[0][:1] and got[6][0] == got[6][3]
    assert counted("x" * 3, "é\u3000ü") == counted("xxx", "é ü")
    bad = np.array([0xE4, 0xB8, 0x61, 0xFF, 0xC2], np.uint8)  # not UTF-8: bytes of a word
    assert len(decontamination.tokens(bad, np.array([0, 5]), powers)[0]) == 1


def test_leaks_without_spaces_and_of_short_items_are_found(docs, spark):
    capital = "中华人民共和国的首都是哪一个城市？请选择正确的答案。"
    items = [(1, capital), (2, "two words"), (3, "北京"), (4, "。！"), (5, "one two three four"), (6, None)]
    texts = {
        1: "以下是题目：" + capital + "答案是上海", 2: "中华人民共和国的首都是哪一个城市", 3: "just TWO, words here", 4: "two other words", 5: "我住在北京市",
        6: "one two three", 7: "so one two three four one two three four", 8: "。！", 9: "words two",
    }
    df, benchmark = docs([(i, t, "en", "a") for i, t in texts.items()]), spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.marked(df, benchmark).filter("contaminated").collect()
    assert {r.doc_id: r.item_id for r in got} == {1: 1, 2: 1, 3: 2, 5: 3, 7: 5}
    assert {r.doc_id: [(t.doc_start, t.item_start, t.length) for t in r.tiles] for r in got if r.item_id != 1} == {3: [(1, 0, 2)], 5: [(3, 0, 2)], 7: [(1, 0, 4)]}


def test_kept_bytes_of_a_plain_text(spark):
    df = spark.sql("select 'abcdef' as text, array(named_struct('start', 1L, 'end', 3L), named_struct('start', 5L, 'end', 6L)) as spans")
    assert bytes(df.select(suffix_dedup.kept_bytes()).first()[0]) == b"ade"
    assert hashlib.sha256(b"ade").hexdigest() == df.select(F.sha2(suffix_dedup.kept_bytes(), 256)).first()[0]


def test_benchmark_blocks_hold_distinct_texts(spark, docs, monkeypatch):
    """One item text repeated far past a block's bytes, beside items that need several blocks."""
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 2000)
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))
    hot, others = text(40), [text(30) for _ in range(60)]
    items = [(900 + k, hot) for k in range(300)] + [(k, t) for k, t in enumerate(others)] + [(5000, None), (5001, ""), (5002, "the")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    blocks = []
    real = decontamination.block_arrays
    monkeypatch.setattr(decontamination, "block_arrays", lambda ids, texts, seed: blocks.append(texts) or real(ids, texts, seed))
    df = docs([(1, "x " + hot + " y", "en", "a"), (2, others[7] + " " + text(50), "en", "a"), (3, text(80), "en", "a"), (4, "the end", "en", "a")])
    got = {r.doc_id: (r.contaminated, r.item_id) for r in decontamination.marked(df, benchmark).collect()}
    assert got == {1: (True, 900), 2: (True, 7), 3: (False, None), 4: (True, 5002)}
    assert len(blocks) > 4 and all(sum(map(len, b)) <= 2000 for b in blocks) and sorted(t for b in blocks for t in b) == sorted([hot, *others, "the"])
    assert decontamination.contaminations(df, benchmark).filter("item_id between 900 and 1199").count() == 300
    longer = {r.doc_id: r.contaminated for r in decontamination.marked(df, benchmark, least=2).collect()}
    assert longer == {1: True, 2: True, 3: False, 4: False}
