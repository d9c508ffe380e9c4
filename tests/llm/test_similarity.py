"""Line dedup, the n-gram join and benchmark leaks against plain versions."""

import random
import time
import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import chosen_path, decontaminate, line_dedup
from rollcall.llm.common import components
from rollcall.session import passing, scratch_dir, staged


class Union(dict):
    def find(self, a):
        self.setdefault(a, a)
        while self[a] != a:
            a = self[a]
        return a

    def join(self, a, b):
        self[max(self.find(a), self.find(b))] = min(self.find(a), self.find(b))


def words(rnd, n, size=400):
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


def corpus(seed=1):
    rnd = random.Random(seed)
    base = [words(rnd, rnd.choice([3, 8, 60, 300])) for _ in range(60)]
    texts = [" ".join(b) for b in base]
    for _ in range(80):  # near copies of a few, one group large
        own = list(rnd.choice(base[:4] + base[30:34]))
        for _ in range(rnd.choice([0, 1, 1, 2])):
            own[rnd.randrange(len(own))] = "changed"
        texts.append(" ".join(own).upper())
    rows = [(i, t, 1, "k") for i, t in enumerate(texts)]
    return [*rows, (500, None, 1, "k"), (501, "", 1, "k"), (502, "!!", 1, "k"), (None, texts[0], 1, "k"), rows[9], rows[9]]


SCHEMA = "doc_id long, text string, class_id int, key string"


def near(a, b, threshold=0.8):
    both = len(a & b)
    return both >= threshold * (len(a) + len(b) - both) - 1e-9


def grams(text):
    own = re.findall(r"\w+", (text or "").lower())
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


@pytest.mark.parametrize("settings", [{}, {"small": 4, "block_tokens": 400, "depth": 3, "recall": 0.9999}])
def test_join_is_the_plain_one(spark, settings):
    data = corpus()
    sets = [grams(t) for _, t, _, _ in data]
    union, links = Union(), [0] * len(data)
    for i in range(len(data)):
        for j in range(i):
            if sets[i] and sets[j] and near(sets[i], sets[j]):
                links[i] += 1
                links[j] += 1
                union.join(i, j)
    least = defaultdict(list)
    for i, row in enumerate(data):
        least[union.find(i)].append(row[0])
    want = sorted(
        (str(row[0]), min((x for x in least[union.find(i)] if x is not None), default=None), links[i])
        for i, row in enumerate(data)
    )
    frame = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = chosen_path.similarity_classes(frame, chosen_path.Settings(**settings)).collect()
    assert sorted((str(r.doc_id), r.class_id, r.n_links) for r in got) == want


def test_one_of_each_class_stays(spark):
    data = corpus()
    frame = spark.createDataFrame(data, SCHEMA)
    kept = chosen_path.keep_one(frame)
    assert kept.columns == frame.columns
    rows = [tuple(r) for r in kept.collect()]
    sets = [grams(r[1]) for r in rows]
    assert not any(near(a, b) for i, a in enumerate(sets) for b in sets[:i] if a and b)
    held = [s for s in sets if s]
    union = Union()
    every = [grams(t) for _, t, _, _ in data]
    for i in range(len(every)):
        union.find(i)
        for j in range(i):
            if every[i] and every[j] and near(every[i], every[j]):
                union.join(i, j)
    assert len(held) == len({union.find(i) for i, s in enumerate(every) if s})
    assert sorted(r[0] for r in rows if r[0] is not None and r[0] >= 500) == [500, 501, 502]
    assert chosen_path.keep_one(frame.where("false")).count() == 0


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(rnd.randrange(100, 160), rnd.randrange(100, 160)) for _ in range(50)] + [(7, 7)]
    edges += [(1000, 1001 + i) for i in range(50)]
    union = Union()
    for a, b in edges:
        if a != b:
            union.join(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((n, union.find(n)) for n in union)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def line_corpus():
    rnd = random.Random(4)
    base = [" ".join(words(rnd, rnd.choice([1, 6, 30, 80]), 3000)) for _ in range(60)]
    rows = []
    for i in range(70):
        own = []
        for _ in range(rnd.randrange(1, 5)):
            line = rnd.choice(base)
            at = rnd.randrange(len(line))
            own.append(rnd.choice([line, line.upper() + " ", line[:at] + "zz" + line[at:], "", f"own line {i} {rnd.random()}"]))
        rows.append((i, "\n".join(own), "x"))
    return [*rows, (200, None, "x"), (201, "", "x"), (None, base[3], "x"), (5, "other text of the same id\n" + base[2], "x")]


def test_lines(spark):
    data = line_corpus()
    frame = spark.createDataFrame(data, "doc_id long, text string, removed string").repartition(2)
    got = {(r.doc_id, r.text0): r for r in line_dedup.dedup_lines(frame.withColumn("text0", frame.text)).collect()}
    places = defaultdict(list)
    for doc_id, text, _ in data:
        for i, line in enumerate((text or "").split("\n")):
            if norm := line.strip(" \t\r\f\v").lower():
                places[norm].append((doc_id is not None, doc_id or 0, i, text))
    lines = list(places)
    sets = [{x[i : i + 8] for i in range(max(1, len(x) - 7))} for x in lines]
    union = Union()
    for i in range(len(lines)):
        union.find(i)
        for j in range(i):
            if near(sets[i], sets[j]):
                union.join(i, j)
    groups = defaultdict(list)
    for i, line in enumerate(lines):
        groups[union.find(i)] += places[line]
    gone = defaultdict(set)
    for own in groups.values():
        for known, doc_id, i, text in sorted(own)[1:]:
            gone[doc_id if known else None, text].add(i)
    assert len(got) == len(data)
    for doc_id, text, _ in data:
        row = got[doc_id, text]
        assert row.removed == sorted(gone[doc_id, text])
        if text is not None:
            assert row.text == "\n".join(x for i, x in enumerate(text.split("\n")) if i not in row.removed)
    assert got[200, None].text is None and got[200, None].n_lines == 0
    assert line_dedup.dedup_lines(frame.where("false")).count() == 0


@pytest.mark.parametrize("block", [16, 512])
def test_lines_of_large_bands_all_meet(spark, block):
    """Families of two lines whose bands are those of their common beginning, and larger than any bound."""
    rnd = random.Random(8)
    start = " ".join(words(rnd, 30, 3000))
    families = []
    for _ in range(60):
        line = start + " " + " ".join(words(rnd, 12, 3000))
        families.append((line, line[:-1] + "#"))
    s = line_dedup.Settings(groups=1, small=4, heads=1, block=block)
    lines = [(2 * i + k, line) for i, pair in enumerate(families) for k, line in enumerate(pair)]
    got = line_dedup.line_classes(spark.createDataFrame(lines, "id long, line string"), s).collect()
    sets = {i: {line[j : j + 8] for j in range(len(line) - 7)} for i, line in lines}
    union = Union()
    for i in sets:
        for j in range(i):
            if near(sets[i], sets[j]):
                union.join(i, j)
    assert len({union.find(i) for i in sets}) > 50
    root = {r.node: r.root for r in got}
    assert [root.get(i, i) for i in sets] == [union.find(i) for i in sets]


def joined(spark, pairs):
    """Whether the lines of each pair are in one component."""
    lines = [(2 * i + k, line) for i, pair in enumerate(pairs) for k, line in enumerate(pair)]
    classes = line_dedup.line_classes(spark.createDataFrame(lines, "id long, line string"))
    root = {r.node: r.root for r in classes.collect()}
    return [root.get(2 * i, 2 * i) == root.get(2 * i + 1, 2 * i + 1) for i in range(len(pairs))]


def test_long_lines_of_few_ngrams(spark):
    pairs = [(c * 250, c * 399) for c in "=-#~"] + [(c * 100, c * 300) for c in "*+_."]
    pairs += [(f"{w} " * 30, f"{w} " * 90) for w in ("ab", "word", "longer")]
    assert all(joined(spark, pairs))


def planted_lines(rnd, size):
    """Two lines of about ``size`` n-grams whose similarity is 0.80 to 0.85."""
    text = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)).replace(" ", "_")
    while True:
        both = rnd.randrange(size // 2, size + 1)
        if 0.80 <= both / (2 * size - both) <= 0.85:
            own = text(both + 7)
            return own + "0" + text(size - both - 1), own + "1" + text(size - both - 1)


def test_pairs_at_the_threshold_are_found(spark):
    rnd = random.Random(12)
    kinds = [20, 40, 150, 400]
    pairs = [planted_lines(rnd, size) for size in kinds for _ in range(1000)]
    sets = [[{x[i : i + 8] for i in range(len(x) - 7)} for x in pair] for pair in pairs]
    assert all(near(a, b) and not near(a, b, 0.86) for a, b in sets)
    found = joined(spark, pairs)
    lost = [1000 - sum(found[i * 1000 : (i + 1) * 1000]) for i in range(len(kinds))]
    # 0.003 of those at the threshold itself may be.
    assert max(lost) <= 8, lost


def distance(item, text):
    """The least word edits between the item and any passage of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_leaks(spark):
    rnd = random.Random(6)
    items = [(i, " ".join(words(rnd, rnd.choice([6, 20, 45, 90]), 900))) for i in range(30)]
    items += [(30, None), (31, ""), (32, "?!"), (33, items[0][1]), (None, items[1][1]), (34, " ".join(words(rnd, 700, 900)))]
    docs = []
    for i in range(150):
        own = words(rnd, rnd.choice([0, 30, 200]), 900)
        if i % 2:
            inner = rnd.choice([x for x in items if x[1] and len(x[1]) < 3000])[1].split()
            for _ in range(rnd.choice([0, 1, int(0.15 * len(inner))])):
                if inner:
                    inner[rnd.randrange(len(inner))] = "changed"
            own[10:10] = inner
        docs.append((i, ", ".join(own), "x"))
    docs += [(200, None, "x"), (201, "", "x"), (202, "so " + items[-1][1], "x"), docs[1], (None, docs[3][1], "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, leaks string")
    rows = decontaminate.mark_leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(rows) == len(docs)
    s = decontaminate.Settings()
    found = wanted = 0
    for r in rows:
        text = re.findall(r"\w+", (r.text or "").lower())
        got = {x.item_id: x for x in r.leaks}
        for item, content in items:
            own = re.findall(r"\w+", (content or "").lower())
            if not own:
                continue
            least = distance(own, text)
            if least <= s.edits(len(own)):
                wanted += 1
                found += item in got
            else:
                assert item not in got
            if item in got:
                x = got[item]
                assert least <= x.edits <= s.edits(len(own))
                assert distance(own, text[x.first_word : x.first_word + x.n_words]) <= x.edits
    assert wanted > 50 and found >= 0.97 * wanted
    assert 34 in {x.item_id for r in rows if r.doc_id == 202 for x in r.leaks}
    assert decontaminate.mark_leaks(frame, spark.createDataFrame([], "item_id long, text string")).where("size(leaks) > 0").count() == 0


KINDS = {"mixed": "sid", "substituted": "s", "inserted": "i", "deleted": "d"}


def edited(rnd, own, edits, kind):
    own = list(own)
    for at in sorted(rnd.sample(range(len(own)), edits), reverse=True):
        step = rnd.choice(KINDS[kind])
        own[at : at + 1] = {"s": ["changed"], "i": [own[at], "added"], "d": []}[step]
    return own


@pytest.mark.parametrize("size", [6, 7, 13, 20, 40, 59, 100, 200, 256])
def test_leaks_at_the_allowed_edits_are_all_found(size):
    rnd, s = random.Random(size), decontaminate.Settings()
    items = [(i, words(rnd, size, 900)) for i in range(10)]
    index = decontaminate.Index([(i, " ".join(own)) for i, own in items], s)
    for kind in KINDS:
        for item, own in items:
            text = [*words(rnd, 30, 900), *edited(rnd, own, s.edits(size), kind), *words(rnd, 30, 900)]
            hashed, _ = decontaminate.word_hashes([" ".join(text)])
            found = index.search(np.append(index.symbols(hashed), np.int32(index.close)))
            got = [x for x in found if index.owners[x[0]] == [item]]
            assert got, (size, kind, item)
            _, first, n, edits = min(got, key=lambda x: x[3])
            assert edits == distance(own, text) == distance(own, text[first : first + n])


def test_leaks_at_the_allowed_edits_count_apart(spark):
    rnd, s = random.Random(8), decontaminate.Settings()
    items = [(i, words(rnd, size, 900)) for i, size in enumerate([20, 45, 90, 200] * 5)]
    planted = [(item, len(own), kind, edited(rnd, own, s.edits(len(own)), kind)) for item, own in items for kind in KINDS]
    docs = [(i, " ".join(words(rnd, 40, 900) + own + words(rnd, 40, 900))) for i, (*_, own) in enumerate(planted)]
    marked = decontaminate.mark_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(own)) for i, own in items], "item_id long, text string"),
    )
    got = {r.doc_id: {x.item_id for x in r.leaks} for r in marked.collect()}
    lost = defaultdict(int)
    for i, (item, size, kind, _) in enumerate(planted):
        lost[size, kind] += item not in got[i]
    assert len(lost) == 16 and not any(lost.values()), lost


def test_bitmaps_rule_out_pairs_but_no_similar_one(spark):
    s, rnd = line_dedup.Settings(), random.Random(5)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.choice([6, 30, 200, 800]))) for _ in range(40)]
    texts = [*base, *(t[: k] + "x" + t[k + 1 :] for t in base for k in (2, len(t) // 2)), "ab" * 300, "ab" * 40]
    lines = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    pairs = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts))]
    left = line_dedup.not_ruled_out(spark.createDataFrame(pairs, "a long, b long"), line_dedup.oddities(lines, s), s)
    left = {tuple(r) for r in left.collect()}

    def grams(t):
        return {t[i : i + s.gram] for i in range(max(1, len(t) - s.gram + 1))}

    sets = [grams(t) for t in texts]
    near = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= s.threshold * len(sets[a] | sets[b])}
    assert near <= left and len(near) > 50
    assert len(left) < 2 * len(near) < len(pairs) / 10
    assert {tuple(r) for r in line_dedup.similar(spark.createDataFrame(pairs, "a long, b long"), lines, s).collect()} == near


def test_pairs_of_a_large_band_that_bitmaps_rule_out_are_never_made(spark):
    """Copies of one line with other words each, nearly all of them just less similar than wanted."""
    s, rnd = line_dedup.Settings(), random.Random(4)
    start = words(rnd, 90, 3000)
    lines = []
    for i in range(160):
        changed = set(rnd.sample(range(90), rnd.choice([4, 9, 9, 9, 10])))
        lines.append((i, " ".join(f"{w}{i}" if k in changed else w for k, w in enumerate(start))))
    texts = spark.createDataFrame(lines, "id long, line string")
    rows = line_dedup.signatures(texts, s).select(
        F.lit(1).cast("long").alias("band"), "id", line_dedup.sketch_of(s).alias("sketch"), F.col("id").alias("root")
    )
    odd = line_dedup.oddities(texts, s, s.sharp_words)
    few = line_dedup.folded(odd, s.odd_words)
    assert few.orderBy("id").collect() == line_dedup.oddities(texts, s).orderBy("id").collect()
    sketch = {r.id: r.sketch for r in rows.collect()}
    left = line_dedup.rest_pairs(line_dedup.rest_rows(rows, s), few, s)
    pairs = {(r.a, r.b) for r in left.collect()}
    sharp = {(r.a, r.b) for r in line_dedup.not_ruled_out(left.select("a", "b"), odd, s).collect()}
    sets = {i: {line[j : j + 8] for j in range(len(line) - 7)} for i, line in lines}
    every = [(a, b) for a in sets for b in range(a + 1, len(sets))]
    similar = {(a, b) for a, b in every if near(sets[a], sets[b])}

    def agree(a, b):
        return sum((sketch[a] ^ sketch[b]) >> 5 * i & 31 == 0 for i in range(s.values)) >= s.values - s.most_unlike

    passed = {(a, b) for a, b in every if agree(a, b)}
    assert similar & passed <= sharp <= pairs <= passed
    assert len(similar) > 50 and len(passed) > 0.7 * len(every)
    assert len(sharp) < 4 * len(similar & passed) and len(pairs) < len(passed) / 2
    best = line_dedup.likeliest(left)
    assert best.count() <= len(lines) and {(r.a, r.b) for r in best.collect()} <= pairs
    roots = spark.createDataFrame([(a, min(a, 5)) for a in range(1, 9)], "node long, root long")
    asked = spark.createDataFrame([(5, 6), (5, 7), (1, 2), (20, 21), (3, 20)], "a long, b long")
    assert {tuple(r) for r in line_dedup.apart(asked, roots).collect()} == {(1, 2), (20, 21), (3, 20)}


def test_line_dedup_leaves_no_stored_frames_but_one(spark):
    docs = spark.createDataFrame([(i, f"a line that comes in all of them\nline {i} of its own") for i in range(5)], "doc_id long, text string")
    folder = Path(scratch_dir(spark, "x")).parent
    before = set(folder.glob("*"))
    rows = line_dedup.dedup_lines(docs)
    left = [p.name.split("-")[0] for p in set(folder.glob("*")) - before]
    assert [n for n in left if n != "checkpoints"] == ["marked"]
    assert sum(len(r.removed) for r in rows.collect()) == 4


def test_frames_of_a_failed_block_stay_and_kept_ones_outlive_it(spark):
    with passing() as outer:
        with passing() as kept:
            gone, stays = staged(spark.range(1), "gone"), kept(staged(spark.range(2), "stays"))
        assert not Path(gone.staged_path).exists() and stays.count() == 2
        outer(stays)
    assert stays.count() == 2
    with pytest.raises(ValueError), passing():
        stays = staged(spark.range(3), "stays")
        raise ValueError
    assert stays.count() == 3


def test_lines_of_a_large_band_are_asked_by_the_larger_bitmap_where_they_meet(spark):
    """What only the larger bitmap rules out is no row of the join either."""
    s, rnd = line_dedup.Settings(), random.Random(4)
    start = words(rnd, 90, 3000)
    lines = []
    for i in range(160):
        changed = set(rnd.sample(range(90), rnd.choice([4, 9, 9, 9, 10])))
        lines.append((i, " ".join(f"{w}{i}" if k in changed else w for k, w in enumerate(start))))
    texts = spark.createDataFrame(lines, "id long, line string")
    rows = line_dedup.signatures(texts, s).select(
        F.lit(1).cast("long").alias("band"), "id", line_dedup.sketch_of(s).alias("sketch"), F.col("id").alias("root")
    )
    odd = line_dedup.oddities(texts, s, s.sharp_words)
    rest = line_dedup.rest_rows(rows, s)
    few = line_dedup.rest_pairs(rest, line_dedup.folded(odd, s.odd_words), s).select("a", "b")
    sharp = {tuple(r) for r in line_dedup.not_ruled_out(few, odd, s).collect()}
    met = {(r.a, r.b) for r in line_dedup.rest_pairs(rest, odd, s).collect()}
    assert met == sharp and 50 < len(met) < few.count() / 2


def test_staged_frames_leave_no_shuffle_files(spark):
    def files():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        stored = manager.getAllFiles()
        names = {stored.apply(i).getName() for i in range(stored.size())}
        return {n for n in names if n.startswith("shuffle_")}

    before = files()
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    stored = staged(rows, "rows")
    assert stored.count() == 10
    made = {n.split("_")[1] for n in files() - before}
    deadline = time.monotonic() + 20
    while time.monotonic() < deadline and len({n.split("_")[1] for n in files() - before}) > 1:
        time.sleep(0.2)
    # That of the count alone may be left.
    assert len({n.split("_")[1] for n in files() - before}) <= 1, made
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_lines_of_a_family_of_similar_ones_meet_a_bounded_number_of_others(spark):
    """All lines are similar: a dealing makes rows by its blocks, and nothing is left for all others."""
    s, rnd = line_dedup.Settings(first_block=16), random.Random(6)
    start = words(rnd, 90, 3000)
    lines = [(i, " ".join(f"{w}{i}" if k == i % 90 else w for k, w in enumerate(start))) for i in range(240)]
    texts = spark.createDataFrame(lines, "id long, line string")
    rows = line_dedup.signatures(texts, s).select(
        F.lit(1).cast("long").alias("band"), "id", line_dedup.sketch_of(s).alias("sketch"), F.col("id").alias("root")
    )
    odd = line_dedup.oddities(texts, s, s.sharp_words)
    rest = line_dedup.rest_rows(rows, s)
    dealt = line_dedup.rest_pairs(rest, odd, s, s.dealings)
    every = line_dedup.rest_pairs(rest, odd, s).count()
    assert every > 25000 and 240 < dealt.count() < every / 4
    assert dealt.where("a >= b").isEmpty()
    joined_by = components(dealt.select("a", "b"))
    assert joined_by.count() == 240 and joined_by.select("root").distinct().count() == 1
