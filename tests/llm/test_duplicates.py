"""Line dedup, near-duplicates, components and fingerprints against brute force."""

import hashlib
import random
import time
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pacewell.llm import components, lines, merkle, neardup


def union(pairs, nodes=()):
    """Smallest member of each node's component."""
    root = {n: n for n in {*nodes, *(x for p in pairs for x in p)}}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in root}


def test_components(spark):
    rng = random.Random(1)
    for edges in ([], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [(rng.randrange(90), rng.randrange(90)) for _ in range(70)]):
        df = spark.createDataFrame([*edges, (None, 5), (5, None), (7, 7)], "a long, b long")
        got = {r["node"]: r["root"] for r in components.components(df).collect()}
        wanted = {n: r for n, r in union(edges).items() if n != r}
        assert got == wanted


def mutated(rng, text, edits, letters="abcé😀 "):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars) + 1)
        kind = rng.random()
        if kind < 0.4:
            chars.insert(at, rng.choice(letters))
        elif kind < 0.7 and len(chars) > 3:
            del chars[min(at, len(chars) - 1)]
        else:
            chars[min(at, len(chars) - 1)] = rng.choice(letters)
    return "".join(chars)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_bit_parallel_distance(spark, threshold):
    rng = random.Random(2)
    rows = []
    for _ in range(400):
        a = "".join(rng.choice("abcé😀") for _ in range(rng.randint(3, 40)))
        rows.append((a, mutated(rng, a, rng.randint(0, 5))))
    df = spark.createDataFrame(rows, "a string, b string").filter(F.length("b") >= threshold)
    near, known = lines.within(F.col("a"), F.col("b"), threshold), F.levenshtein("a", "b") <= threshold
    assert df.filter(near != known).isEmpty() and df.filter(known).count() > 20
    could = lines.plausible(F.col("a"), F.col("b"), threshold)
    assert df.filter(known & ~could).isEmpty()
    words = df.select(F.regexp_replace("a", "c", " ").alias("a"), F.regexp_replace("b", "c", " ").alias("b"))
    flips = F.bit_count(lines.word_parity(F.col("a")).bitwiseXOR(lines.word_parity(F.col("b"))))
    assert words.filter((F.levenshtein("a", "b") <= threshold) & (flips > 3 * threshold)).isEmpty()
    far = df.select("a", F.reverse("b").alias("b")).filter("length(a) > 30")
    assert far.filter(could).count() < 0.5 * far.count()


def brute_lines(rows, threshold, least):
    """Class (first line) and number of links of each line."""
    def near(a, b):
        if min(len(a), len(b)) < least or abs(len(a) - len(b)) > threshold:
            return False
        above = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            now = [i]
            for j, y in enumerate(b, 1):
                now.append(min(above[j] + 1, now[-1] + 1, above[j - 1] + (x != y)))
            above = now
        return above[-1] <= threshold

    found = {}
    for i, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                found.setdefault(line, []).append((i is None, i or 0, n))
    links = [(a, b) for a, b in combinations(sorted(found), 2) if near(a, b)]
    root = union(links, found)
    first = {}
    for line, places in found.items():
        first[root[line]] = min(first.get(root[line], (True, 1 << 60, 0)), *places)
    counts = {line: sum(line in p for p in links) for line in found}
    return {(i, n): (first[root[line]][1], first[root[line]][2], counts[line]) for line, places in found.items() for _, i, n in places}


def test_lines_against_all_pairs(documents):
    rng = random.Random(4)
    base = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(1, 12))) for _ in range(40)]
    rows = []
    for i in range(60):
        own = [rng.choice(base) for _ in range(rng.randint(0, 6))]
        rows.append((i, "\n".join(mutated(rng, line, rng.choice([0, 0, 1, 2, 3])) if rng.random() < 0.7 else line for line in own), "en", "a"))
    got = lines.line_classes(documents(rows)).collect()
    wanted = brute_lines([r[:2] for r in rows], lines.THRESHOLD, lines.LEAST_CHARS)
    assert {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"], r["n_links"]) for r in got} == wanted
    assert all(r["kept"] == ((r["doc_id"], r["line_no"]) == (r["class_doc_id"], r["class_line_no"])) for r in got)
    assert sum(r["n_links"] for r in got) > 20


def distance(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(above[j] + 1, now[-1] + 1, above[j - 1] + (x != y)))
        above = now
    return above[-1]


def test_near_lines_follow_the_length(spark):
    """One changed word in lines of 100 to 600 characters, scattered edits below, and one edit in short lines."""
    rng = random.Random(6)
    found, wanted = [], set()

    def word():
        return "".join(rng.choice("abcdefghiklmnoprstuvwy") for _ in range(rng.randint(3, 9)))

    for chars in [*range(10, 104, 3), 19, 20, 59, 60, 79, 80, 99, 100, *range(105, 620, 25), 2000]:
        base = word()
        while len(base) < chars:
            base += " " + word()
        base = base[:chars].strip().ljust(chars, "z")
        words = base.split(" ")
        changed = list(words)
        changed[rng.randrange(len(words))] = word()
        near = mutated(rng, base, 1 if chars < 20 else max(2, min(chars, 99) // 20), "qxjé😀") if chars < 100 else None
        found += [base, " ".join(changed), *filter(None, [near])]
    found = sorted(set(found))
    for a, b in combinations(found, 2):
        n, m = sorted((len(a), len(b)))
        most = 0 if n < 10 else 1 if n < 20 else max(2, n // 20)
        if m - n <= most and distance(a, b) <= most:
            wanted.add((a, b))
    ids = spark.createDataFrame(list(enumerate(found)), "id long, line string")
    got = {(found[r["a"]], found[r["b"]]) for r in lines.near_lines(ids).collect()}
    assert got == wanted and sum(len(a) >= 100 for a, _ in wanted) > 15 and sum(len(a) < 20 for a, _ in wanted) >= 3


def test_two_edits_anywhere_in_long_lines(spark):
    """Few words, many words, and numbers of words about the bound between segments and runs."""
    rng = random.Random(12)
    made = []
    for i in range(150):
        n = rng.choice([1, 5, *range(17, 27), 60])
        size = -(-110 // n)
        line = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(max(1, size + rng.randint(-1, 2)))) for _ in range(n))
        line += "z" * (100 - len(line))
        other = line
        for _ in range(2):
            at = rng.choice([rng.randrange(len(other)), *[j for j, c in enumerate(other) if c == " "][:: max(1, n // 3)]])
            other = other[:at] + rng.choice(["", "q", " ", other[at] + " "]) + other[at + 1 :]
        if other != line and len(other) >= lines.LONG_CHARS:
            made.append((line, other))
    every = {x: i for i, x in enumerate(sorted({x for pair in made for x in pair}))}
    found = lines.near_lines(spark.createDataFrame([(i, x) for x, i in every.items()], "id long, line string"))
    got = {(r["a"], r["b"]) for r in found.collect()}
    assert len(made) > 120 and all(tuple(sorted((every[a], every[b]))) in got for a, b in made)


def test_scattered_edits_up_to_the_limit_in_long_lines(spark):
    """As many edits as the limit allows, at even places and at any, so that no words in a row need be alike."""
    rng = random.Random(21)
    made = []
    for size in [100, 101, 119, 120, 139, 159, 160, 199, 260, 399, 400, 700, 1500]:
        for even in (True, False):
            line = "".join(rng.choice("abcdefghijklmnoprstu    ") for _ in range(size - 1)) + "z"
            edits, other = size // 20, line
            for e in reversed(range(edits)):
                at = (size * e + size // 2) // edits if even else rng.randrange(len(other))
                other = other[:at] + rng.choice(["", "Q", other[at] + "Q"]) + other[at + 1 :]
            most = max(2, min(len(line), len(other)) // 20)
            if other != line and min(len(line), len(other)) >= lines.LONG_CHARS and abs(len(line) - len(other)) <= most and distance(line, other) <= most:
                made.append((line, other))
    # 23 words in 160 characters, every third one changed: no three in a row are alike.
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(23)]
    made.append((" ".join(words), " ".join("Q" + w[1:] if i % 3 == 2 else w for i, w in enumerate(words))))
    every = {x: i for i, x in enumerate(sorted({x for pair in made for x in pair}))}
    found = lines.near_lines(spark.createDataFrame([(i, x) for x, i in every.items()], "id long, line string"))
    got = {(r["a"], r["b"]) for r in found.collect()}
    assert len(made) > 15 and got == {tuple(sorted((every[a], every[b]))) for a, b in made}


def test_filters_miss_no_hash_and_are_few_rows(spark):
    """A broadcast row holds many words, and most hashes that are not in a filter are dropped."""
    keys = spark.range(6000).select(F.xxhash64("id").alias("key"))
    words = lines._words(6000)
    held = lines._held(keys.unionByName(keys.limit(0).unionByName(spark.range(500).select(F.xxhash64("id").alias("key")))), words).collect()
    assert len(held) == -(-words // (1 << lines.BUCKET_BITS)) and all(len(r["bits"]) == len(r["shared"]) == min(words, 1 << lines.BUCKET_BITS) for r in held)
    held = spark.createDataFrame(held, "bucket int, bits array<long>, shared array<long>")
    tried = spark.range(20000).select("id", F.xxhash64("id").alias("key")).withColumn("bucket", lines._bucket(words)).join(held, "bucket")
    found = tried.select("id", lines._in("bits", words).alias("in"), lines._in("shared", words).alias("twice")).collect()
    assert len(found) == 20000 and all(r["in"] for r in found if r["id"] < 6000) and all(r["twice"] for r in found if r["id"] < 500)
    assert sum(r["in"] for r in found) < 8000 and sum(r["twice"] for r in found) < 800


def test_long_lines_of_neighbouring_classes_and_moved_blocks(spark):
    """The shorter line's length is of the class below, and all its edits stand before the block that is alike."""
    rng = random.Random(33)
    made = []
    for bound in [lines.CLASS_RATIO**k for k in range(21, 32)]:
        size = int(bound)
        base = "".join(rng.choice("abcdefghéñ😀    ") for _ in range(size - 1)) + "z"
        for edits in (1, size // 20):
            made.append((base, "".join(rng.choice("QRS") for _ in range(edits)) + base))
            step = size // edits
            made.append((base, "".join(c + ("Q" if i % step == 0 and i // step < edits else "") for i, c in enumerate(base))))
    every = {x: i for i, x in enumerate(sorted({x for pair in made for x in pair}))}
    found = lines.near_lines(spark.createDataFrame([(i, x) for x, i in every.items()], "id long, line string"))
    got = {(r["a"], r["b"]) for r in found.collect()}
    assert len(made) == 44 and {tuple(sorted((every[a], every[b]))) for a, b in made} <= got


def test_long_lines_meet_in_rounds_with_filters_of_their_own(spark, monkeypatch):
    """However many blocks there are, a filter holds those of one round; pairs of lines in different rounds are found, each once."""
    assert lines.rounds({3: 5, 1: 4, 2: 6, 4: 30, 5: 1}, 10) == [[1, 2], [3], [4], [5]] and lines.rounds({}, 10) == []
    rng = random.Random(34)
    every = []
    for bound in [lines.CLASS_RATIO**k for k in range(21, 29)]:
        size = int(bound)
        base = "".join(rng.choice("abcdefgh    ") for _ in range(size - 1)) + "z"
        every += [base, "Q" * (size // 20) + base, base[: size // 2] + "R" + base[size // 2 :], base[:-1] + "y"]
    table = spark.createDataFrame(list(enumerate(every)), "id long, line string").withColumn("length", F.length("line"))
    wanted = sorted((r["a"], r["b"]) for r in lines.long_candidates(table).collect())
    sizes, held = [], lines._held

    def counted(keys, words, *more):
        sizes.append(keys.count())
        return held(keys, words, *more)

    monkeypatch.setattr(lines, "_held", counted)
    monkeypatch.setattr(lines, "ROUND_BLOCKS", 120)
    assert sorted((r["a"], r["b"]) for r in lines.long_candidates(table).collect()) == wanted and len(wanted) >= 8 * 5
    assert len(sizes) >= 6 and max(sizes[::2]) <= 120


def test_lines_that_are_not_valid_text(spark):
    rows = spark.createDataFrame([(1, "a" * 60 + "bcdefghijk" * 8), (2, "a" * 60 + "bcdefghijk" * 7 + "bcdefghijX")], "id long, line string")
    odd = rows.select(F.col("id") + 10, F.expr("cast(concat(cast(line as binary), X'ff') as string)"))
    assert {(r["a"], r["b"]) for r in lines.near_lines(rows.union(odd)).collect()} == {(1, 2), (1, 11), (1, 12), (2, 11), (2, 12), (11, 12)}


def test_distance_of_what_differs(spark):
    rng, rows = random.Random(5), []
    for _ in range(300):
        a = "".join(rng.choice("ab é") for _ in range(rng.randint(1, 40)))
        rows.append((a, mutated(rng, a, rng.randint(0, 5))))
    df = spark.createDataFrame(rows + [("", ""), ("a", "aa"), ("aba", "ababa")], "a string, b string")
    less = lines.differing(F.col("a"), F.col("b"), lambda a, b: F.levenshtein(a, b))
    assert df.where(less != F.levenshtein("a", "b")).isEmpty()


def test_no_python_in_line_dedup(spark):
    plan = lines.op1_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan


def test_texts_without_repeated_lines(documents, odd_rows):
    out = lines.without_repeated_lines(documents(odd_rows))
    assert out.columns == documents(odd_rows).columns
    texts = {}
    for r in out.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert texts[1] == [odd_rows[0][1]] and 6 not in texts  # all that document 6 says stands in document 1
    assert texts[2] == [None] and texts[3] == [""] and texts[4] == [odd_rows[3][1]] and texts[5] == [odd_rows[5][1]]
    assert lines.without_repeated_lines(documents([])).count() == 0
    part = [(1, "first line of its own text\nshared line in both of them", "en", "a"), (2, "shared line in both of them\n\nsecond text has this one", "en", "a")]
    assert [r["text"] for r in lines.without_repeated_lines(documents(part)).orderBy("doc_id").collect()] == [part[0][1], "\nsecond text has this one"]


def shingles(text, words):
    found = [w.lower() for w in (text or "").encode().split()]  # bytes lower only A-Z
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1)) or (frozenset([tuple(found)]) if found else frozenset())


def near_copies(rng, n_groups, size):
    rows = []
    for _ in range(n_groups):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(1, 150))]
        for _ in range(rng.randint(1, size)):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 99)}"
            if rng.random() < 0.3:
                words = own  # a chain: later copies are of this one
            rows.append(" ".join(own).upper() if rng.random() < 0.1 else "  ".join(own))
    rng.shuffle(rows)
    return [(i, t, "en", "a") for i, t in enumerate(rows)]


@pytest.mark.parametrize("like", [neardup.Likeness(3, 85), neardup.Likeness()])
def test_near_duplicates_against_all_pairs(documents, like, monkeypatch):
    rows = near_copies(random.Random(8), 40, 14)
    sets = {i: shingles(t, like.words) for i, t, _, _ in rows}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and like.whole * len(sets[a] & sets[b]) >= like.part * len(sets[a] | sets[b])]
    wanted = union(links, sets)
    got = neardup.near_duplicates(documents(rows), like).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == wanted and len(links) > 50
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_large_clusters_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_DOCS", 8)
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 8)
    rows = near_copies(random.Random(9), 2, 120)
    like = neardup.Likeness(3, 85)
    sets = {i: shingles(t, 3) for i, t, _, _ in rows}
    links = [(a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(documents(rows), like).collect()}
    assert got == union(links, sets)


def test_near_duplicates_of_odd_rows(documents, odd_rows):
    got = neardup.near_duplicates(documents(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    found = {r["doc_id"]: r for r in got}
    assert found[6]["component_id"] == 1 and not found[6]["kept"] and found[1]["kept"]
    assert found[2]["n_shingles"] == found[3]["n_shingles"] == found[4]["n_shingles"] == 0
    kept = neardup.kept_documents(documents(odd_rows))
    assert kept.columns == documents(odd_rows).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, *_ in odd_rows if i != 6)
    assert neardup.near_duplicates(documents([])).count() == 0 and neardup.kept_documents(documents([])).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    errors = []
    for share in (0.2, 0.5, 0.8, 0.95):
        for n in (200, 5000):
            both = int(2 * n * share / (1 + share))
            values = rng.integers(0, 2**63, 2 * n - both, dtype=np.uint64) * np.uint64(2)
            a, b = values[:n], values[n - both :]
            rows = neardup.registers(np.concatenate([a, b, values]), np.array([0, n, 2 * n, 4 * n - both]))
            assert np.array_equal(neardup.merged(rows[0], rows[1]), rows[2])
            sizes = np.array([float(n)]), np.array([float(n)])
            guesses = [g for g in np.arange(0.01, 1, 0.01) if neardup.at_least(g, rows[:1], rows[1:2], *sizes)[0]]
            errors.append(abs(max(guesses, default=0) - share))
    assert max(errors) < 0.17 and np.mean(errors) < 0.06


def plain_fingerprint(text):
    """The tree by hand: leaves into paragraphs, paragraphs into sections, sections into the root."""
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    done, section = [], []
    for line in (text or "").split("\n"):
        words = line.split(" ")
        runs, step = [], merkle.LEAF_WORDS
        for i in range(0, len(words), step):
            run = " ".join(words[i : i + step])
            runs.append(run + " " if i + step < len(words) else run)
        hashes = [md5(r) for r in runs]
        node = md5(",".join(hashes))
        section.append(f"{node}={','.join(h[: merkle.LEAF_DIGITS] for h in hashes)}")
        if node[0] in merkle.CUTS:
            done.append(";".join(section))
            section = []
    done += [";".join(section)] if section else []
    parts = [f"{md5(s)}:{s}" for s in done]
    root = hashlib.sha256(",".join(p[: merkle.NODE_DIGITS] for p in parts).encode()).hexdigest()
    return "|".join([root, *parts])


def test_merkle_tree_by_hand(spark, odd_rows):
    texts = [t for _, t, _, _ in odd_rows] + ["\n\n", " x", "x ", "a b c d e f", "a b c d e f ", "a b c d e f g", *("\n".join(["same line"] * n) for n in (1, 2, 40))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select("t", merkle.fingerprint(F.col("t")).alias("f")).collect()
    assert [r["f"] for r in found] == [plain_fingerprint(r["t"]) for r in found]


def test_merkle_locates_edits(spark):
    lines = [f"paragraph {i} says some words of its own, number {i * i}, and then ends" for i in range(200)]
    changed = lines[:90] + [lines[90].replace("says", "denies")] + lines[91:]
    inserted = lines[:90] + ["one more line stands here"] + lines[90:]
    df = spark.createDataFrame([tuple("\n".join(x) for x in (lines, y)) for y in (changed, inserted, lines)] + [("", None), ("a", "b")], "a string, b string")
    a, b = merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))
    rows = df.select(a.alias("a"), b.alias("b")).select(
        "a", "b", merkle.likeness(F.col("a"), F.col("b")).alias("l"), merkle.changed_sections(F.col("a"), F.col("b")).alias("new"),
        merkle.changed_sections(F.col("b"), F.col("a")).alias("gone"), merkle.sections(F.col("b")).alias("parts")).collect()
    for row, line in ((rows[0], changed[90]), (rows[1], inserted[90])):
        assert 0.95 < row["l"] < 1 and row["a"] != row["b"]
        assert len(row["new"]) <= 2 and len(row["gone"]) <= 2  # two only where the new line ends a section
        node = plain_fingerprint(line).split(":")[1].split("=")[0]
        assert any(node in row["parts"][i] for i in row["new"])
        assert len(row["parts"]) > 12
    assert len(rows[1]["new"]) == 1
    assert (rows[2]["l"], rows[2]["new"], rows[2]["a"] == rows[2]["b"]) == (1.0, [], True)
    assert rows[3]["l"] == 1.0 and rows[3]["a"] == rows[3]["b"] and rows[4]["l"] == 0.0


def test_time_of_a_fingerprint_follows_the_lines(spark):
    def seconds(n):
        text = "\n".join(f"line {i} of a long text has some words" for i in range(n))
        df = spark.createDataFrame([(text,)], "t string").select(merkle.likeness(merkle.fingerprint(F.col("t")), merkle.fingerprint(F.lower("t"))))
        df.collect()
        begun = time.perf_counter()
        df.collect()
        return time.perf_counter() - begun

    assert seconds(16_000) < 16 * 6 * max(seconds(1_000), 0.05)  # a square would be 256 times as long


def test_next_texts(documents, odd_rows):
    rows = [(i, t, None, None) for i, t in [(5, "five"), (-3, "m"), (9, "nine"), (7, None), (1, "one"), (None, "none"), (9, "nine")]]
    for parts in (1, 3, 20):
        got = {(r["doc_id"], r["text"]): r["next_text"] for r in merkle.with_next(documents(rows), parts).collect() if r["doc_id"] != 9}
        assert got == {(None, "none"): "m", (-3, "m"): "one", (1, "one"): "five", (5, "five"): "", (7, ""): "nine"}
        nines = sorted(r["next_text"] for r in merkle.with_next(documents(rows), parts).collect() if r["doc_id"] == 9)
        assert nines == ["nine", "none"]
    assert merkle.with_next(documents([])).count() == 0
    assert merkle.fingerprints(documents(odd_rows)).count() == len(odd_rows)


def test_words_of_a_chunk():
    from pacewell.llm import textbytes

    texts = ["a bb", None, "", "  ", "c", "dd\n e"]
    words = []
    for first, _, data, offsets in textbytes.chunks(pa.array(texts), limit=4):
        starts, ends, rows = textbytes.word_spans(data, offsets)
        words += [(first + r, data[s:e].tobytes()) for s, e, r in zip(starts, ends, rows)]
    assert words == [(0, b"a"), (0, b"bb"), (4, b"c"), (5, b"dd"), (5, b"e")]
