"""The stages of the pipeline against plain versions, each on what the one before it kept."""

import random
import re
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from rollcall.llm.common import DOCUMENT_COLUMNS
from test_similarity import Union, distance, grams, near

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, removed int, leaks string"
SYLLABLES = {"aa": ["ka", "lo", "mi", "ru"], "bb": ["ße", "ün", "är", "ok"]}


def make(rnd, lang, n):
    return ["".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(2, 5))) for _ in range(n)]


def corpus():
    rnd = random.Random(9)
    rows, items = [], [(i, " ".join(make(rnd, "aa", 30))) for i in range(5)]
    shared = " ".join(make(rnd, "bb", 20))
    for i in range(160):
        lang = rnd.choice(list(SYLLABLES))
        lines = [" ".join(make(rnd, lang, rnd.randint(8, 40))) for _ in range(rnd.randint(1, 4))]
        if i % 10 == 3:
            lines.append(shared)
        if i % 10 == 5:
            lines[0] += " " + rnd.choice(items)[1]
        if i % 10 == 7 and rows:
            own = rows[-1][1].split("\n")[0].split()
            lines = [" ".join([*own[:4], "zzz", *own[4:]]), *lines]
        rows.append((i, "\n".join(lines), lang))
    rows += [(300, None, "aa"), (301, "", "bb"), (302, "12 34", "aa"), rows[4], (303, rows[8][1], None)]
    return [(i, t, lang, "s", len(t or ""), 1, "x") for i, t, lang in rows], items


def plain_lines(docs):
    places = defaultdict(list)
    for doc_id, text in docs:
        for i, line in enumerate(text.split("\n")):
            if norm := line.strip().lower():
                places[norm].append((doc_id, i))
    lines = list(places)
    sets = [{x[i : i + 8] for i in range(max(1, len(x) - 7))} for x in lines]
    union = Union()
    for i in range(len(lines)):
        union.find(i)
        for j in range(i):
            if near(sets[i], sets[j]):
                union.join(i, j)
    groups = defaultdict(set)
    for i, line in enumerate(lines):
        groups[union.find(i)] |= set(places[line])
    gone = {p for own in groups.values() for p in sorted(own)[1:]}
    out = []
    for doc_id, text in docs:
        left = "\n".join(x for i, x in enumerate(text.split("\n")) if (doc_id, i) not in gone)
        if left.strip():
            out.append((doc_id, left))
    return out


def test_stages(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    named = [name for name, _ in corpus_pipeline.STAGES]
    kept, frames = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, str(tmp_path))
        path = f"{tmp_path}/stage-{name}"
        kept.write.parquet(path)
        kept = spark.read.parquet(path)
        frames[name] = kept
        if name != named[-1]:
            assert kept.columns == list(DOCUMENT_COLUMNS)
    texts = {n: sorted((r.doc_id, r.text) for r in f.collect()) for n, f in frames.items() if n != named[-1]}
    assert texts[named[0]] == sorted((r[0], r[1]) for r in rows if r[1] and re.search("[a-zß]", r[1]))
    # A row that is repeated stays repeated until similar documents are looked for.
    assert texts[named[1]] == sorted(plain_lines(texts[named[0]]))
    assert all(r.n_chars == len(r.text) for r in frames[named[1]].collect())
    union, before = Union(), texts[named[1]]
    sets = [grams(t) for _, t in before]
    for i in range(len(before)):
        union.find(i)
        for j in range(i):
            if sets[i] and sets[j] and near(sets[i], sets[j]):
                union.join(i, j)
    least = {}
    for i, row in enumerate(before):
        least[union.find(i)] = min(least.get(union.find(i), row), row)
    assert texts[named[2]] == sorted(least.values())
    tokens = lambda t: re.findall(r"\w+", t.lower())
    clean = [
        (i, t) for i, t in texts[named[2]]
        if all(distance(tokens(x), tokens(t)) > int(0.15 * len(tokens(x))) for _, x in items)
    ]
    assert texts[named[3]] == clean and len(clean) < len(texts[named[2]])
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in clean)
    packed = frames[named[4]].collect()
    assert sum(r.length for r in packed) == want and {r.doc_id for r in packed} == {i for i, _ in clean}
    assert len({r.sequence_id for r in packed}) <= -(-want // 2048) + 1


def test_run_and_empty_tables(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(items, "item_id long, text string").where("false").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(rows, SCHEMA).where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
