"""Near-duplicates, nearest neighbours, URLs, reply trees, sharding and the pipeline against plain versions."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlake.llm import components, covering_simhash, dimension_scan, near_copies, reply_trees, two_pass_shuffle, url_filter
from visitlake.llm.queries import URL_RULES


def roots(pairs, nodes):
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def test_masks_cover_every_pair_within_the_radius():
    draw = random.Random(0)
    tables = covering_simhash.masks(4)
    assert len(tables) == 31 and all(24 <= (mask & (1 << 64) - 1).bit_count() <= 40 for mask in tables)
    for _ in range(2000):
        difference = sum(1 << bit for bit in draw.sample(range(64), draw.randint(0, 4)))
        assert any(mask & difference == 0 for mask in tables)


def test_components_of_chains_stars_and_loops(spark):
    draw = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (500, 501), (501, 500)]
    pairs += [(draw.randint(1000, 1300), draw.randint(1000, 1300)) for _ in range(150)]
    found = components.components(spark.createDataFrame(pairs + [(None, 3)], "a long, b long")).collect()
    nodes = {node for pair in pairs for node in pair if pair[0] != pair[1]}
    assert {row["node"]: row["root"] for row in found} == roots([p for p in pairs if p[0] != p[1]], nodes)
    assert len(found) == len(nodes)


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    base = [" ".join(draw.choice("abcdefghijklmnop") * draw.randint(1, 4) for _ in range(120)) for _ in range(40)]
    found = [(i, text) for i, text in enumerate(base)]
    for i in range(160):
        words = draw.choice(base[:6]).split()
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(len(words))] = f"new{draw.randint(0, 3)}"
        found.append((100 + i, " ".join(words)))
    return found + [(300, None), (301, ""), (302, " \n"), (303, "one two"), (304, "ONE two"), (None, base[0]), (7, base[7]), (7, base[7])]


@pytest.mark.parametrize("tile", [4096, 3])
def test_near_duplicates_equal_brute_force(spark, texts, tile, monkeypatch):
    monkeypatch.setattr(covering_simhash.links, "__defaults__", (tile,))
    frame = spark.createDataFrame([(i, text, 1) for i, text in texts], "doc_id bigint, text string, node int")
    found = covering_simhash.near_duplicates(frame).collect()
    assert len(found) == len(texts)
    prints = {fingerprint(text) for _, text in texts}
    pairs = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    root = roots(pairs, prints)
    least = {}
    for number, text in texts:
        if number is not None:
            least[root[fingerprint(text)]] = min(number, least.get(root[fingerprint(text)], number))
    expected = sorted((str(number), fingerprint(text), least[root[fingerprint(text)]]) for number, text in texts)
    assert sorted((str(row[0]), row[1] % (1 << 64), row[2]) for row in found) == expected
    assert covering_simhash.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [1024, 4])
def test_kept_documents_equal_brute_force(spark, texts, tile):
    frame = spark.createDataFrame([(i, text, 1, "x") for i, text in texts], "doc_id bigint, text string, node int, key string")
    kept = near_copies.drop_near_duplicates(frame, tile=tile, prints=6)
    assert kept.columns == frame.columns
    sets = {}
    for _, text in texts:
        words = tuple((text or "").lower().split())
        sets[words] = {words[i:i + 5] for i in range(max(1, len(words) - 4))}
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = roots(pairs, sets)
    least = {}
    for number, text in texts:
        group, key = root[tuple((text or "").lower().split())], (number is None, number or 0)
        least[group] = min(key, least.get(group, key))
    assert sorted(row["doc_id"] for row in kept.collect()) == sorted(number for _, number in least.values())
    assert near_copies.drop_near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [1024, 4])
def test_added_and_cut_passages_are_found(spark, tile):
    """Production defaults on copies that lie beyond all fingerprints; a group of many and pairs, and texts too far apart."""
    draw = random.Random(8)

    def words(count):
        return ["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(count)]

    texts, groups = [], []
    for number in range(30):
        base = words(120)
        others = [base + words(18), base[:102], words(17) + base] if number else [base + words(12) for _ in range(12)]
        groups.append(range(len(texts), len(texts) + 1 + len(others)))
        texts += [base, *others]
    base = words(120)
    apart = [len(texts), len(texts) + 1]
    texts += [base, base + words(40)]  # 0.74
    frame = spark.createDataFrame([(i, " ".join(text)) for i, text in enumerate(texts)], "doc_id bigint, text string")
    kept = near_copies.drop_near_duplicates(frame, tile=tile)
    assert sorted(row["doc_id"] for row in kept.collect()) == [*(group[0] for group in groups), *apart]


def exact_neighbours(rows, queries, k):
    found = []
    for number, vector in queries:
        scored = {(-float(np.dot(np.array(vector, float), np.array(other, float))), i) for i, other in rows if i != number}
        found += [(number, rank, i, -score) for rank, (score, i) in enumerate(sorted(scored)[:k], 1)]
    return found


def usable_rows(rows):
    kept = [(i, v) for i, v in rows if v and i is not None and len(v) == 12 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    return sorted({(i, tuple(v)) for i, v in kept})


def test_nearest_with_ties_bad_vectors_and_small_tables(spark):
    draw = np.random.default_rng(4)
    vectors = draw.integers(-3, 4, (300, 12)).astype(float).tolist()
    rows = list(enumerate(vectors)) + [(1000 + i, [1.0] * 12) for i in range(60)] + [(0, vectors[0])]
    rows += [(2000, None), (2020, [0.0] * 12), (2040, [float("nan")] * 12), (2060, [float("inf")] + [1.0] * 11), (2080, []),
             (2100, [1.0] * 5), (2120, [None] + [1.0] * 11), (None, [1.0] * 12)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, ids string")
    is_query = F.col("vec_id") % 20 == 0
    found = dimension_scan.nearest(frame, is_query)
    known = usable_rows(rows)
    expected = exact_neighbours(known, [(i, v) for i, v in known if i % 20 == 0], 20)
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    few = frame.filter(F.col("vec_id") < 5)
    assert sorted(map(tuple, dimension_scan.nearest(few, is_query).collect())) == exact_neighbours(
        [row for row in known if row[0] < 5], [known[0]], 20)
    assert dimension_scan.nearest(frame.limit(0), is_query).count() == 0


def test_nearest_recall_when_lists_are_probed(spark):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(40, 24))
    vectors = centres[draw.integers(0, 40, 4000)] + 0.6 * draw.normal(size=(4000, 24))
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id bigint, embedding array<double>")
    found = dimension_scan.nearest(frame, F.col("vec_id") % 50 == 0, k=10, probe=0.5, least_probed=100).collect()
    hits = 0
    for query in range(0, 4000, 50):
        scores = vectors @ vectors[query]
        scores[query] = -np.inf
        best = set(np.argsort(-scores)[:10].tolist())
        own = {row["vec_id"]: row["score"] for row in found if row["query_id"] == query}
        assert len(own) == 10 and all(abs(scores[i] - score) < 1e-9 for i, score in own.items())
        hits += len(best & own.keys())
    assert hits >= 0.9 * 800


def test_url_rules_and_list(spark):
    urls = [None, "", "no scheme", "http://A.NET", "http://a.net/x", "http://b.example.net/en/1", "http://example.com/de/",
            "http://notexample.com/de/", "https://x.org/fr/a?b#c", "http://y.io/p?b=2&a=1&utm_source=q#f", "https://www.y.io/p/?a=1&b=2",
            "http://y.io/p?a=1", "http://z.io:80/", "x://", "http://é.IO/ß"]
    listed = spark.createDataFrame([("http://y.io/p?a=1&b=2",), ("http://y.io/p?a=1&b=2",), (None,), ("https://m.z.io",)], "url string")
    pages = spark.createDataFrame([(i, url, "h") for i, url in enumerate(urls * 2)], "page_id bigint, url string, host string")
    found = {row["page_id"]: row for row in url_filter.judge(pages, URL_RULES, listed).collect()}
    assert len(found) == 2 * len(urls)
    verdicts = [(found[i]["host"], found[i]["path"], found[i]["rule"], found[i]["verdict"]) for i in range(len(urls))]
    assert verdicts[:4] == [("", "", None, "allow")] * 3 + [("a.net", "", None, "allow")]
    assert verdicts[4] == ("a.net", "/x", "net/", "block")
    assert verdicts[5] == ("b.example.net", "/en/1", "example.net/en/", "allow")
    assert verdicts[6] == ("example.com", "/de/", "example.com/de/", "block")
    assert verdicts[7][2:] == (None, "allow")
    assert verdicts[8] == ("x.org", "/fr/a", "org/fr/", "allow")
    assert [verdict[3] for verdict in verdicts[9:]] == ["block", "block", "allow", "block", "allow", "allow"]
    assert verdicts[14][0] == "é.io"
    assert url_filter.judge(pages.limit(0), URL_RULES, listed).count() == 0
    assert {row["verdict"] for row in url_filter.judge(pages.filter("url LIKE '%y.io%'"), [], listed.limit(0)).collect()} == {"allow"}


def test_bloom_filter_passes_every_key(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("canonical"))
    words = url_filter.bloom_filter(keys, 100).scalar()
    lanes = words[url_filter._block(F.col("canonical"), 100)]
    passes = F.lit(True)
    for lane, bit in enumerate(url_filter._bits(F.col("canonical"))):
        passes = passes & (lanes[lane].bitwiseAND(bit) == bit)
    assert keys.filter(passes).count() == 3000
    others = spark.range(3000).select(F.concat(F.lit("other"), "id").alias("canonical"))
    assert others.filter(passes).count() < 60


REPLIES = "tree string, node long, parent long, score double, role string, text string"


def test_reply_trees(spark):
    rows = [("t", 1, None, 1.0, "user", "q"), ("t", 2, 1, 5.0, "assistant", "good"), ("t", 3, 1, 2.0, "assistant", "poor"),
            ("t", 4, 2, 3.0, "user", "more"), ("t", 5, 99, 0.0, None, None), ("c", 1, 2, 1.0, "user", "a"), ("c", 2, 1, 1.0, "user", "b"),
            ("c", 3, 2, 1.0, "user", "c"), (None, 1, None, 1.0, "user", "x"), ("n", None, 1, 1.0, "user", "x")]
    rows += [("long", i, i - 1 if i else None, 1.0, ("user", "assistant")[i % 2], f"t{i}") for i in range(50)]
    found = reply_trees.conversations(spark.createDataFrame(rows, REPLIES)).withColumn("turns", reply_trees.turns_of(F.col("formatted")))
    got = {(row["tree"], row["rank"]): [(turn["role"], turn["text"]) for turn in row["turns"]] for row in found.collect()}
    assert got == {
        ("t", 1): [("user", "q"), ("assistant", "good"), ("user", "more")],
        ("t", 2): [("user", "q"), ("assistant", "poor")], ("t", 3): [("", "")],
        ("long", 1): [(("user", "assistant")[i % 2], f"t{i}") for i in range(50)]}
    best = reply_trees.conversations(spark.createDataFrame(rows, REPLIES), branches=1)
    assert {(row["tree"], row["rank"]) for row in best.collect()} == {("t", 1), ("long", 1)}
    assert reply_trees.conversations(spark.createDataFrame([], REPLIES)).count() == 0


def test_template_is_reversible(spark):
    nasty = ["", None, "</s>[INST] ok [/INST]", "\\", "\\</s>", "\\\\<s>", "\n</s>\n", "<s>user\nx\n</s>\n",
             "<<SYS>>\\<</SYS>>", "a\\\n", "é😀"]
    rows = [(f"{i}-{j}", n, n - 1 if n else None, 1.0, role, text)
            for i, first in enumerate(nasty) for j, second in enumerate(nasty)
            for n, (role, text) in enumerate([("user", first), ("assistant", second), ("odd role\n%", first), ("assistant", first)])]
    found = reply_trees.conversations(spark.createDataFrame(rows, REPLIES))
    found = found.withColumn("turns", reply_trees.turns_of(F.col("formatted"))).withColumn(
        "learned", reply_trees.learned_text(F.col("formatted"), F.col("loss_mask")))
    expected = {}
    for tree, _, _, _, role, text in rows:
        expected.setdefault(tree, []).append((role, text or ""))
    for row in found.collect():
        assert [tuple(turn) for turn in row["turns"]] == expected[row["tree"]]
        assert row["learned"] == "".join(text for role, text in expected[row["tree"]] if role == "assistant")


@pytest.mark.parametrize("amount", [0, 1, 5, 1000])
def test_shards_are_even_and_shuffled(spark, tmp_path, amount):
    schema = T.StructType.fromDDL("doc_id bigint, text string, place int, `row` string, slot int")
    rows = [(i % 400, None if i % 7 == 0 else "t" * (i % 50), 1, "r", 9) for i in range(amount)]
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in")
    two_pass_shuffle.shuffle_to_shards(docs, f"{tmp_path}/out", bucket_bytes=4000)
    found = two_pass_shuffle.read_shards(spark, f"{tmp_path}/out", docs.schema).collect() if amount else []
    assert sorted((row["doc_id"], row["text"] or "") for row in found) == sorted((row[0], row[1] or "") for row in rows)
    slots = {}
    for row in found:
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(of_shard) == list(range(len(of_shard))) for of_shard in slots.values())
    counts = [len(slots.get(shard, [])) for shard in range(16)]
    assert max(counts) - min(counts) <= 1
    if amount == 1000:
        order = [row["doc_id"] for row in sorted(found, key=lambda row: (row["shard"], row["slot"]))]
        assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.15


def joins_of(frame):
    """Kind and first key of each join as planned before anything ran, when Spark knows the sizes of files only."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"(\w+Join) \[(?:\w+\()?(\w+)#", plan)


def test_listed_tables_are_never_broadcast(spark):
    nodes = spark.createDataFrame([(1, [5]), (2, [7]), (3, [1 << 40])], "node long, prints array<long>")
    found = covering_simhash.links(covering_simhash.staged(nodes, "nodes"), 4)
    assert joins_of(found) == [("SortMergeJoin", "bucket")]
    assert roots([tuple(row) for row in found.collect()], [1, 2, 3]) == {1: 1, 2: 1, 3: 1}
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (3, None)], "doc_id long, text string")
    found = covering_simhash.near_duplicates(docs)
    assert all(kind == "SortMergeJoin" for kind, key in joins_of(found) if key == "root")
    assert joins_of(found)[0] == ("SortMergeJoin", "fingerprint")
    assert {row["doc_id"]: row["component_id"] for row in found.collect()} == {1: 1, 2: 1, 3: 3}


def test_joins_of_near_copies_shuffle_what_grows(spark, monkeypatch):
    planned = {}

    def staged(frame, name):
        planned.setdefault(name, []).append(joins_of(frame))
        return kept(frame, name)

    kept = near_copies.staged
    monkeypatch.setattr(near_copies, "staged", staged)
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, " ".join(words + [f"v{i}" for i in range(12)])), (4, "other"), (4, "other")]
    found = near_copies.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    last = joins_of(found)
    assert sorted(row["doc_id"] for row in found.collect()) == [1, 4]
    # Of clusters their tiles, of pairs the pairs, of kept keys the keys: none of them goes through the driver.
    assert ("SortMergeJoin", "node") in planned["similar"][0]
    assert all(("SortMergeJoin", "a") in joins for joins in planned["similar"][1:])
    assert planned["stopped"] == [[("SortMergeJoin", "key")]]
    assert last == [("SortMergeJoin", "key")]


def test_pipeline_on_a_small_table(spark, tmp_path):
    import corpus_pipeline
    draw = random.Random(6)
    words = ["the", "river", "of", "town", "stone", "is", "green", "and", "walks", "along", "water", "every", "light", "door", "small"]

    def prose():
        return "\n".join(" ".join(draw.choice(words) + str(draw.randint(0, 400)) * (draw.random() < 0.4) for _ in range(30)) + "."
                         for _ in range(4))

    texts = [prose() for _ in range(30)]
    near = texts[3].split(" ")
    near[50] = "changed"
    rows = [(i, text) for i, text in enumerate(texts)] + [(100, texts[0]), (101, " ".join(near)), (102, None), (103, "12 34 !!"),
                                                         (104, "a | b | c | d | e | f\n" * 20)]
    frame = spark.createDataFrame([(i, text, "en", "src", len(text or "")) for i, text in rows],
                                  "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {row["doc_id"] for row in pieces} == set(range(30))
    docs = frame
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == frame.columns, name
        assert stage(spark, frame.limit(0), str(tmp_path)).count() == 0


CLASHING = ["_language", "language", "row", "text", "key", "node", "quality", "_quality", "__text", "hash", "a.b", "n_chars"]


def test_pipeline_stages_keep_columns_of_any_name(spark):
    """Names that a stage makes itself, or made before, and one with a dot."""
    import corpus_pipeline
    prose = ("The weather of the day was mild and the people of the village went to the market in the morning, where they bought "
             "bread, apples and a little cheese before the rain came over the hills.")
    rows = [(number, "en", *[f"{prose} Number {number}." if name == "text" else 7 if name == "n_chars" else f"{name} {number}"
                             for name in CLASHING]) for number in (1, 2, 3)]
    schema = "doc_id long, lang string, " + ", ".join(f"`{name}` {'int' if name == 'n_chars' else 'string'}" for name in CLASHING)
    docs = spark.createDataFrame([*rows, (4, "en", *[None] * len(CLASHING))], schema)
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "lang", *CLASHING], name
    kept = {row["doc_id"]: row for row in docs.collect()}
    assert len(kept) >= 1 and 4 not in kept
    for number, row in kept.items():
        assert all(row[name] == f"{name} {number}" for name in CLASHING if name not in ("text", "n_chars"))


def test_url_verdicts_keep_columns_of_any_name(spark):
    names = ["_canonical", "_found", "canonical", "found", "row", "a.b"]
    pages = spark.createDataFrame([("http://x.com/a?utm_x=1", *names), (None, *names), ("http://y.net/", *names)],
                                  "url string, " + ", ".join(f"`{name}` string" for name in names))
    listed = spark.createDataFrame([("https://www.x.com/a/",), (None,)], "url string")
    found = url_filter.judge(pages, URL_RULES, listed)
    assert found.columns == ["url", *names, "host", "path", "rule", "verdict"]
    rows = sorted(((row["url"] or "", row["verdict"]) for row in found.collect()))
    assert rows == [("", "allow"), ("http://x.com/a?utm_x=1", "block"), ("http://y.net/", "block")]
    assert all(row[name] == name for row in found.collect() for name in names)


def test_a_run_that_many_texts_share_leads_to_few_pairs(spark, monkeypatch):
    """Each of 5,000 texts has one run of words in common with all others, and enough runs of its own to come first."""
    texts = [f"{' '.join(f'own{number}w{place}' for place in range(20))} this very run is shared" for number in range(5000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    original = near_copies._prefix_pairs
    monkeypatch.setattr(near_copies, "_prefix_pairs", lambda *given: seen.append(original(*given)) or seen[-1])
    assert near_copies.drop_near_duplicates(frame).count() == 5000
    assert len(seen) == 2 and sum(pairs.count() for pairs in seen) == 0


def test_widespread_runs_come_last_and_lose_no_pair(spark, monkeypatch):
    """Texts that consist of widespread runs, but for a few words, are still compared."""
    monkeypatch.setattr(near_copies, "WIDESPREAD", 3)
    monkeypatch.setattr(near_copies, "BUCKET_RUNS", 64)
    draw = random.Random(12)
    common = [[f"c{part}w{place}" for place in range(60)] for part in range(4)]
    texts = []
    for number in range(60):
        words = [word for part in draw.sample(common, draw.randint(1, 3)) for word in part] + [f"x{draw.randint(0, 6)}" for _ in range(draw.randint(0, 9))]
        texts.append(" ".join(words))
    sets = {}
    for text in texts:
        words = text.split()
        sets[text] = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = roots(pairs, sets)
    least = {}
    for number, text in enumerate(texts):
        least.setdefault(root[text], number)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(row["doc_id"] for row in near_copies.drop_near_duplicates(frame).collect()) == sorted(least.values())
