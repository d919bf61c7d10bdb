"""Exact, near and passage duplicates, archives and shards against brute force."""

import base64
import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.llm import exact, sharding, simhash, substring, warc

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def key(value):
    return (value is not None, value or 0)


def test_exact_groups(docs, rows, monkeypatch):
    groups = defaultdict(list)
    for r in rows:
        groups[lowered(r[1])].append(r[0])
    want = sorted(
        (str(r[0]), r[1] or "", str(max(groups[lowered(r[1])], key=key)), len(groups[lowered(r[1])]))
        for r in rows
    )

    def found():
        return sorted(
            (str(r["row"]["doc_id"]), r["row"]["text"] or "", str(r["keep_id"]), r["group_size"])
            for r in exact.exact_duplicates(docs).collect()
        )

    assert found() == want
    monkeypatch.setattr(exact, "FIRST_DIGIT", 1)
    monkeypatch.setattr(exact, "WIDER", 3)
    assert found() == want


def test_exact_hot_groups_are_broadcast(spark):
    hot = spark.range(2500).selectExpr("id as doc_id", "if(id % 5 < 2, 'Copy of it', concat('t', id)) as text")
    sizes = Counter(r["group_size"] for r in exact.exact_duplicates(hot).collect())
    assert sizes == {1000: 1000, 1: 1500}
    hot = hot.union(spark.range(1500).selectExpr("id as doc_id", "'copy OF it' as text"))
    sizes = Counter(r["group_size"] for r in exact.exact_duplicates(hot).collect())
    assert sizes == {2500: 2500, 1: 1500}


def test_exact_keep_one(docs, rows):
    kept = exact.keep_one(docs)
    assert kept.columns == docs.columns
    texts = [lowered(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({lowered(r[1]) for r in rows})


def test_empty_tables(empty, spark):
    assert exact.exact_duplicates(empty).count() == 0
    assert exact.keep_one(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0
    assert substring.repeated_passages(empty).count() == 0
    assert sharding.balanced_shards(empty, F.col("text"), 3).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(pages).count() == 0


@pytest.mark.parametrize("name", ["_doc", "_key", "key", "row", "fp", "label", "a.b", "n words", "chunk"])
def test_columns_of_any_name(spark, name):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(1, words, 7), (2, words, 8), (3, None, 9), (4, "alone", None)]
    docs = spark.createDataFrame(rows, T.StructType.fromDDL(f"doc_id long, text string, `{name}` long"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r[2] or 0 for r in kept.collect()) == [0, 7, 9]
    cut = substring.repeated_passages(docs).collect()
    assert {r["row"][0]: (r["row"][2], r["spans"]) for r in cut} == {
        1: (7, []), 2: (8, [[0, 30]]), 3: (9, []), 4: (None, [])
    }


def plain_fingerprint(text, size):
    words = _WORD.findall(lowered(text))
    if not words:
        return 0
    size = min(size, len(words))
    runs = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, radius):
    label = {f: f for f in fps}
    for _ in fps:
        changed = False
        for a, b in itertools.combinations(label, 2):
            if (a ^ b).bit_count() <= radius and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
        if not changed:
            return label
    return label


@pytest.mark.parametrize("radius", [1, 2, 12])
def test_near_duplicates(docs, rows, radius):
    fps = [plain_fingerprint(r[1], 3) for r in rows]
    label = classes(set(fps), radius)
    least = defaultdict(list)
    for r, f in zip(rows, fps):
        least[label[f]].append(r[0])
    name = {c: min((i for i in ids if i is not None), default=None) for c, ids in least.items()}
    want = sorted((str(r[0]), f"{f:016x}", str(name[label[f]])) for r, f in zip(rows, fps))
    got = simhash.near_duplicates(docs, radius=radius).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == want
    kept = simhash.keep_one(docs, radius=radius).select("doc_id", "text").distinct().collect()
    assert len(kept) == len(name)


def test_large_shards_are_refined_and_searched_tree_by_tree(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centre = int(rng.integers(0, 1 << 62))
    fps = {centre}
    while len(fps) < 150:
        f = centre
        for b in rng.integers(0, 64, 3):
            f ^= 1 << int(b)
        fps.add(f)
    fps |= {int(x) for x in rng.integers(0, 1 << 63, 50)}
    signed = [(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps]
    frame = spark.createDataFrame(signed, "fp long")
    want = classes(fps, 2)
    for tree in (4096, 40, 3):
        monkeypatch.setattr(simhash, "TREE", tree)
        got = {f: f for f in fps}
        for a, b in simhash.links(frame, 2).collect():
            a, b = a % (1 << 64), b % (1 << 64)
            assert (a ^ b).bit_count() <= 128
            old, new = sorted((got[a], got[b]), reverse=True)
            got = {f: new if c == old else c for f, c in got.items()}
        assert got == want


def test_trees_follow_the_radius():
    rng = np.random.default_rng(4)
    fp = rng.integers(0, 1 << 10, 300).astype(np.uint64)
    shard = np.sort(rng.integers(0, 3, 300))
    trees = simhash.Trees(shard, fp)
    for radius in (0, 1, 3):
        found = set()
        for q, n in trees.within(fp, trees.root, radius):
            found |= set(zip(q.tolist(), n.tolist()))
        want = {
            (i, j)
            for i in range(300)
            for j in range(300)
            if shard[i] == shard[j] and int(fp[i] ^ fp[j]).bit_count() <= radius
        }
        assert found == want


def plain_passages(rows, span):
    words = [_WORD.findall(r[1] or "") for r in rows]
    first = {}
    order = [float("inf") if r[0] is None else r[0] for r in rows]
    for doc, w in zip(order, words):
        for i in range(len(w) - span + 1):
            run = tuple(w[i : i + span])
            first[run] = min(first.get(run, float("inf")), doc)
    out = []
    for r, doc, w in zip(rows, order, words):
        gone = set()
        for i in range(len(w) - span + 1):
            if first[tuple(w[i : i + span])] < doc:
                gone.update(range(i, i + span))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(r[0]), r[1] or "", len(w), len(gone), kept))
    return sorted(out)


@pytest.mark.parametrize("span,seed,chars", [(13, 5, 4_000_000), (13, 5, 700), (6, 3, 300), (13, 13, 10)])
def test_passages(docs, rows, monkeypatch, span, seed, chars):
    from gleanwork.llm import chunks

    monkeypatch.setattr(chunks, "CHUNK_CHARS", chars)
    got = substring.repeated_passages(docs, span=span, seed=seed).collect()
    found = []
    for r in got:
        for (_, a), (b, _) in zip(r["spans"], r["spans"][1:]):
            assert a < b  # maximal: never touching
        removed = sum(b - a for a, b in r["spans"])
        text = r["row"]["text"] or ""
        found.append((str(r["row"]["doc_id"]), text, r["n_words"], removed, r["kept_text"]))
    assert sorted(found) == plain_passages(rows, span)


PAGES = [
    (1, "http://Example.org/a?x=1", "<p>one</p>"),
    (2, "http://example.org/a?x=1", "<p>one</p>"),
    (3, "https://sub.example.org:8080", "two\r\n\r\nWARC/1.1\r\n\r\n"),
    (4, None, None),
    (5, "not a url ::", ""),
    (6, "http://[bad", "é" * 3000),
    (7, "http://a.b/\r\nX: y", "<p>one</p>"),
    (7, "http://a.b/again", "<p>one</p>"),
    (None, "http://a.b/none", "<p>one</p>"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_archives(spark, least, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 2)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = warc.archive_pages(pages, least_bytes=least).collect()
    kept = defaultdict(int)
    for page, _, html in PAGES:
        kept[html or ""] = max(kept[html or ""], page or 0)
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        refers = kept[html or ""] if page and len(data) >= least and page < kept[html or ""] else None
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((str(page), len(data), digest, "revisit" if refers else "response", str(refers)))
    found = [
        (str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"]))
        for r in got
    ]
    assert sorted(found) == sorted(want)
    ordered = sorted(got, key=lambda r: (r["range"], r["place"]))
    keys = [(r["url_key"], r["captured"], *key(r["page_id"])) for r in ordered]
    assert keys == sorted(keys)


def test_loser_tree():
    rng = np.random.default_rng(0)
    for k in range(0, 9):
        runs = [sorted((int(v), i) for v in rng.integers(0, 20, rng.integers(0, 9))) for i in range(k)]
        merged = list(warc.LoserTree([[(x, x) for x in r] for r in runs]))
        assert [m[0] for m in merged] == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("http://www.Example.org/A?b") == "org,example,www)/a?b"
    assert warc.url_key("https://x.y:8443") == "y,x:8443)/"


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards(docs, rows, shards):
    marked = docs.select("doc_id", "text", F.coalesce("text", F.lit("")).alias("same"))
    got = sharding.balanced_shards(marked, F.col("same"), shards).collect()
    assert sorted(str(r["row"]["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    slots = defaultdict(list)
    places = defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        places[r["row"]["same"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(len(p) == 1 for p in places.values())


def test_shards_split_a_group_that_is_too_large(spark):
    rows = spark.range(900).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) as same")
    got = sharding.balanced_shards(rows, F.col("same"), 4).collect()
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes.values()) == {225}
    hot = Counter(r["shard"] for r in got if r["row"]["same"] == "hot")
    assert max(hot.values()) == 225


def split_groups(got, key="same"):
    places = defaultdict(set)
    for r in got:
        places[r["row"][key]].add(r["shard"])
    return sum(len(p) > 1 for p in places.values())


@pytest.mark.parametrize("linked", [400, 700, 1000])
@pytest.mark.parametrize("spacing", ["near", "far"])
def test_shards_unite_pairs(spark, linked, spacing):
    """1 000 rows, the first ``linked`` of them in pairs."""
    partner = "id div 2" if spacing == "near" else f"(id * 37 + 11) % {linked} % {linked // 2}"
    same = F.expr(f"if(id < {linked}, cast({partner} as string), concat('alone ', id))")
    got = sharding.balanced_shards(spark.range(1000).withColumn("same", same), F.col("same"), 4).collect()
    assert Counter(r["shard"] for r in got) == {s: 250 for s in range(4)}
    assert split_groups(got) == 0


def least_split(sizes, targets):
    """Fewest groups that do not fit into shards as a whole; single rows fill up."""
    states = {tuple(targets): 0}
    for n in sizes:
        after = {}
        for room, lost in states.items():
            after[room] = min(lost + 1, after.get(room, 99))  # its rows go where room is left
            for s, r in enumerate(room):
                if r >= n:
                    key = (*room[:s], r - n, *room[s + 1 :])
                    after[key] = min(lost, after.get(key, 99))
        states = after
    return min(states.values())


@pytest.mark.parametrize("seed", range(6))
def test_shards_against_all_assignments(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = [2] * int(rng.integers(3, 9)) + [3] * int(rng.integers(0, 3))
    keys = [f"g{i}" for i, n in enumerate(sizes) for _ in range(n)]
    keys += [f"alone {i}" for i in range(int(rng.integers(3, 9)))]
    rng.shuffle(keys)
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, same string").coalesce(1)
    got = sharding.balanced_shards(rows, F.col("same"), 3).collect()
    assert least_split(sizes, sharding._targets(len(keys), 3)) <= split_groups(got)
    assert split_groups(got) <= least_split(sizes, sharding._targets(len(keys), 3)) + 1


@pytest.mark.parametrize("seed", range(50))
def test_planned_moves_keep_shards_within_their_room(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 7))
    wishes = {(a, b): int(rng.integers(0, 9)) for a in range(n) for b in range(n) if a != b and rng.random() < 0.6}
    either = {(a, b): int(rng.integers(0, 9)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.6}
    room = [int(r) for r in rng.integers(0, 4, n)]
    fixed, turned = sharding.plan_moves(wishes, either, room)
    for s in range(n):
        grown = sum(fixed[a][s] + turned[a][s] - fixed[s][a] - turned[s][a] for a in range(n))
        assert grown <= room[s]
    assert all(0 <= fixed[a][b] <= wishes.get((a, b), 0) for a in range(n) for b in range(n))
    assert all(turned[a][b] + turned[b][a] <= k for (a, b), k in either.items())
    assert all(min(x) >= 0 for x in turned)
