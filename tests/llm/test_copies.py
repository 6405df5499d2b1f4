"""Near copies, lines, spans and the pipeline: plain versions, hot groups and odd input."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from assayer.llm import jaccard, linedup, spans
from assayer.llm.components import components
from assayer.llm.queries import QUERIES


def plain_components(texts, size, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    least = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return {i: (len(sets[i]), least[i]) for i in ids}


def near_copies(seed, n, words, changes):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(len(own))] = f"x{rng.randint(0, 10**6)}"
        out.append(" ".join(own[rng.randint(0, 3) :]))
    return out


def test_components_of_many_near_copies(spark, monkeypatch):
    texts = [t for k, (n, words, changes) in enumerate(((120, 150, 6), (60, 40, 2), (40, 12, 1), (30, 3, 1), (50, 7, 1), (50, 400, 20))) for t in near_copies(k, n, words, changes)]
    random.Random(9).shuffle(texts)
    texts = dict(enumerate([*texts, "", None, "one", "one", "One TWO"]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(7)
    for size, percent in ((4, 85), (5, 80)):
        expected = plain_components(texts, size, percent)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, size, percent).collect()} == expected
    monkeypatch.setattr(jaccard, "TILE_ROWS", 16)  # blocks of many tiles
    expected = plain_components(texts, 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()} == expected


def test_linked_sets_share_a_strip():
    rng = np.random.default_rng(3)
    bounds = jaccard.levels(1 << 40)
    tried = 0
    for _ in range(3000):
        n = int(rng.integers(1, 200))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        lost = int(rng.integers(0, max(1, n // 8) + 1))
        y = np.unique(np.concatenate((rng.permutation(x)[lost:], rng.integers(0, 1 << 63, int(rng.integers(0, max(1, n // 8) + 1))).astype(np.uint64))))
        o, u = len(np.intersect1d(x, y)), len(np.union1d(x, y))
        if len(y) and o < u and 100 * o >= 85 * u:
            tried += 1
            everything = np.union1d(x, y)
            for share in (0, 0.3, 0.9, 1):  # whatever counts as frequent
                frequent = everything[rng.random(len(everything)) < share]
                assert len(np.intersect1d(jaccard.strip_marks(x, bounds, 85, frequent), jaccard.strip_marks(y, bounds, 85, frequent)))
    assert tried > 500


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000), (-3, 2000)]
    random.Random(3).shuffle(edges)
    for per_task in (10, 30, 1000):
        rows = components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(6), per_task).collect()
        assert {r.node: r.label for r in rows} == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(50)}, -3: -3, 2000: -3}
        assert len(rows) == 93
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_near_copies_of_odd_texts(spark, odd_docs, no_docs):
    rows = jaccard.jaccard_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    found = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert found[7, 29998] == 6 and found[11, 1] == 10 and found[4, 0] == 4 and found[None, 2] is None
    kept = jaccard.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 1, 2, 3, 4, 5, 6, 8, 9, 10] and ids.count(None) == 3  # id 1 has two texts
    assert jaccard.jaccard_components(no_docs).count() == 0


def plain_lines(texts, least=8):
    places = [(i, n, line.lower().split()) for i in sorted(texts) for n, line in enumerate((texts[i] or "").split("\n"))]
    firsts, gone = {}, set()
    for i, n, words in places:
        if not words:
            continue
        if tuple(words) in firsts:
            gone.add((i, n))
            continue
        if len(words) >= least:
            for other in firsts:
                if len(other) >= least and abs(len(other) - len(words)) <= 1 and word_edits(other, tuple(words)) <= 1:
                    gone.add((i, n))
                    break
        firsts[tuple(words)] = (i, n)
    return {i: None if t is None else "\n".join(line for n, line in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in texts.items()}


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines_within_one_edit(spark):
    rng = random.Random(8)
    base = [[f"w{rng.randint(0, 30)}" for _ in range(n)] for n in (8, 9, 10, 15, 40)]
    texts = {}
    for i in range(80):
        lines = []
        for _ in range(rng.randint(1, 5)):
            words = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 1)] = [f"x{rng.randint(0, 3)}"] * rng.randint(0, 1)
            lines.append(rng.choice(("", "  ")) + " ".join(words).replace("w1 ", "W1\t"))
        texts[i] = "\n".join(lines)
    texts |= {100: None, 101: "", 102: "\n\n", 103: "short line", 104: "short  LINE\nend"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: r.text for r in linedup.dedup_lines(docs).collect()}
    assert found == plain_lines(texts)


def test_a_hot_line_and_its_near_copies(spark):
    line = [f"word{k}" for k in range(20)]
    rows = [(i, " ".join([*line[:5], f"other{i}", *line[6:]]) + "\nalways the same line here") for i in range(3000)]
    found = linedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), count_as="gone").collect()
    assert {(r.doc_id == 0, r.text == "", r.gone) for r in found} == {(True, False, 0), (False, True, 2)}


def test_lines_of_odd_texts(spark, odd_docs, no_docs):
    found = linedup.dedup_lines(odd_docs)
    assert found.columns == odd_docs.columns and found.count() == odd_docs.count()
    rows = found.where("doc_id in (1, 2, 3, 4, 5)").collect()
    assert sorted((r.doc_id, r.text) for r in rows if r.doc_id == 2) == [(2, "Other line here.")]
    assert [r.text for r in rows if r.doc_id == 1].count("one two three four five six seven eight nine ten.\nShort line.") == 2
    assert {r.doc_id: r.text for r in rows if r.doc_id in (3, 4, 5)} == {3: None, 4: "", 5: " \n\t \n"}
    assert linedup.dedup_lines(no_docs).count() == 0


def plain_spans(texts, least):
    seen, out = set(), {}
    for i in sorted(texts):
        pieces = spans.sentences(texts[i] or "")
        words = [p.lower().split() for p in pieces]
        covered, runs = set(), set()
        for a in range(len(pieces)):
            if not words[a]:
                continue
            for way in (1, -1):
                b, total = a, len(words[a])
                while total < least and 0 <= b + way < len(pieces):
                    b += way
                    total += len(words[b])
                if total >= least:
                    runs.add((min(a, b), max(a, b)))
        for a, b in sorted(runs):
            key = tuple(tuple(w) for w in words[a : b + 1] if w)
            if key in seen:
                covered.update(range(a, b + 1))
            seen.add(key)
        out[i] = texts[i] if texts[i] is None else "".join(p for k, p in enumerate(pieces) if k not in covered)
    return out


def test_spans_as_by_brute_force(spark):
    rng = random.Random(11)
    pool = [" ".join(f"w{rng.randint(0, 50)}" for _ in range(rng.randint(1, 30))) + rng.choice(".!?") for _ in range(60)]
    passage = " ".join(rng.sample(pool, 6))
    texts = {i: " ".join(rng.choice(pool) for _ in range(rng.randint(1, 8))) + (f"\nStart {i}. {passage} End {i}." if i % 3 == 0 else "\n\n") for i in range(120)}
    texts |= {200: None, 201: "", 202: "...!!!\n\n"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    assert {r.doc_id: r.text for r in spans.remove_repeated_spans(docs).collect()} == plain_spans(texts, spans.LEAST_WORDS)


def test_spans_of_odd_texts(spark, odd_docs, no_docs):
    found = spans.remove_repeated_spans(odd_docs)
    assert found.columns == odd_docs.columns and found.count() == odd_docs.count()
    assert {r.doc_id: r.text for r in found.where("doc_id in (10, 11, 3)").collect()} == {3: None, 10: "tie " * 40, 11: ""}
    assert spans.remove_repeated_spans(no_docs).count() == 0


def test_passages_within_one_long_sentence_go(spark):
    rng = random.Random(5)
    shared = [f"{rng.choice('abcdefgh')}{rng.randint(0, 10**6)}" for _ in range(300)]
    own = lambda n: [f"x{rng.randint(0, 10**9)}" for _ in range(n)]
    texts = {1: own(90) + shared + own(41), 2: own(17) + shared + own(8), 3: own(200), 4: own(33) + shared[100:160] + own(5)}
    kept = {r.doc_id: r.text for r in spans.remove_repeated_spans(spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id bigint, text string")).collect()}
    assert kept[1] == " ".join(texts[1]) and kept[3] == " ".join(texts[3])
    for i, part in ((2, shared), (4, shared[100:160])):
        left = set(kept[i].split()) & set(part)
        assert len(left) < 2 * 2 * spans.LONG and set(texts[i]) - set(part) <= set(kept[i].split())


def test_sentences_join_to_the_text_and_are_short():
    rng = random.Random(6)
    for text in ("", "\n", "tie " * 400, "天地玄黄。宇宙洪荒！\n「日月盈昃」。 a b。c", "字" * 300, "a" * 500, " ".join(f"w{rng.random()}" for _ in range(5000)), "İ. ẞ " * 40, "one. two\x85three\u3000four"):
        pieces = spans.sentences(text)
        assert "".join(pieces) == text
        assert max((len(spans.words_of(p)) for p in pieces), default=0) <= 2 * spans.LONG
    assert spans.words_of("Ab 天地 c天d") == ["ab", "天", "地", "c", "天", "d"]
    assert spans.sentences("天地玄黄。宇宙洪荒！\nAb。") == ["天地玄黄。", "宇宙洪荒！\n", "Ab。"]


def test_repeated_passages_in_scripts_without_spaces_go(spark):
    rng = random.Random(7)
    han = lambda n: "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(n))
    passage = "。".join(han(14) for _ in range(5)) + "。"
    docs = spark.createDataFrame([(1, han(9) + "。" + passage + han(8)), (2, han(11) + "！" + passage + han(7)), (3, han(90))], "doc_id bigint, text string")
    before, kept = ({r.doc_id: r.text for r in d.collect()} for d in (docs, spans.remove_repeated_spans(docs)))
    assert kept == before | {2: before[2].replace(passage, "")}


def test_counts_replace_columns_of_their_names(spark, odd_docs):
    docs = odd_docs.withColumns({"n_sentences": F.lit("a"), "n_removed": F.lit("b")})
    found = spans.remove_repeated_spans(docs, count_as=("n_sentences", "n_removed"))
    assert sorted(found.columns) == sorted(docs.columns) and found.where("doc_id = 11").first()["n_removed"] > 0
    lines = linedup.dedup_lines(docs, count_as="n_removed")
    assert sorted(lines.columns) == sorted(docs.columns) and lines.where("doc_id = 11").first()["n_removed"] == 1


def test_span_query_matches_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: r.text for r in QUERIES["op6_substring_dedup"](spark, sf_dir).collect()} == plain_spans(texts, spans.LEAST_WORDS)


def test_pipeline_stage_by_stage(spark, sf_dir):
    from assayer.llm import decontam, packing, toxicity

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]

    clean = stages["toxicity"](spark, docs, sf_dir)
    bad = {r.doc_id for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).where("predicted = 1").collect()}
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert clean.columns == docs.columns and set(texts) == {r.doc_id for r in docs.collect()} - bad

    lines = stages["line_dedup"](spark, clean, sf_dir)
    assert lines.columns == docs.columns
    texts = plain_lines(texts)
    assert {r.doc_id: r.text for r in lines.collect()} == texts

    lines = corpus_pipeline.landed(lines, "test-lines")
    one = stages["ngram_jaccard_join"](spark, lines, sf_dir)
    kept = {i for i, (_, least) in plain_components(texts, 5, 80).items() if i == least}
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == kept

    items = [decontam.words_of((r.text or "").encode()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = {tuple(w[k : k + 10]) for w in items for k in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}
    hit = set()
    for i in kept:
        w = decontam.words_of((texts[i] or "").encode())
        if any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1)):
            hit.add(i)
    left = stages["benchmark_decontamination"](spark, corpus_pipeline.landed(one, "test-one"), sf_dir)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == kept - hit

    packed = stages["best_fit_packing"](spark, corpus_pipeline.landed(left, "test-left"), sf_dir).collect()
    assert {r.doc_id for r in packed} == kept - hit
    columns = ("doc_id", "piece", "length", "ids_crc32")
    assert sorted(tuple(r[c] for c in columns) for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(tuple(r[c] for c in columns) for r in packed)
    assert packing.CAPACITY == 2048


def test_rows_that_share_an_id_are_judged_each_on_its_own(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "s"), (5, text + " x", "s"), (5, "quite another text of its own words here", "s"), (7, "one more", "b"), (7, "one more", "a"), (8, "", "s"), (8, "", "s"), (None, text, "s")]
    kept = jaccard.keep_one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), 5, 80).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([rows[0], rows[2], rows[4], rows[5], rows[7]], key=repr)


def test_pipeline_of_nothing(spark, tmp_path, sf_dir):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
