"""Toxicity, repeats, leaks, secrets, urls and licences: brute force, held-out accuracy and edge cases."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import leaks, licences, repeats, secrets, toxicity, urls

FOLDER = "/root/testdata/sf0.01"


# --- toxicity ------------------------------------------------------------------------------


def brute_segments(scores):
    """Maximal scoring segments by their definition: the best segment, then both sides of it."""
    best, at = 0.0, None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > best + 1e-12:
                best, at = total, (a, b + 1)
    if at is None:
        return []
    a, b = at
    return brute_segments(scores[:a]) + [(a, b)] + [(x + b, y + b) for x, y in brute_segments(scores[b:])]


@pytest.mark.parametrize("seed", range(40))
def test_segments_are_the_maximal_ones(seed):
    scores = np.random.default_rng(seed).integers(-5, 5, 40) + np.random.default_rng(seed + 99).random(40) / 100
    assert [(a, b) for a, b, _ in toxicity.segments(scores)] == brute_segments(scores.tolist())


def test_segments_take_linear_time_on_descending_runs():
    scores = np.tile([1.0, -0.5], 50_000)
    assert len(toxicity.segments(scores)) == 1
    assert toxicity.segments(np.zeros(0)) == [] and toxicity.segments(np.full(9, -1.0)) == []


def toxic_docs(spark):
    rnd = random.Random(4)
    plain, bad = [f"word{i}" for i in range(300)], ["grim", "vile", "foul", "nasty"]
    docs, labels = [], []
    for i in range(900):
        words = [rnd.choice(plain) for _ in range(rnd.randint(20, 120))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        docs.append((i, " ".join(words), i % 2))
        labels.append((i, int(toxic)))
    extra = [(None, "grim vile foul nasty grim", 0), (1001, None, 0), (1002, "", 1), (1003, "word1 " * 200_000, 1), (5, docs[5][1], 1)]
    return spark.createDataFrame(docs + extra, "doc_id long, text string, score int"), spark.createDataFrame(labels + [(None, 1), (7, None)], "doc_id long, toxic int")


def test_held_out_toxic_rows_are_found(spark):
    docs, labels = toxic_docs(spark)
    rows = toxicity.score_documents(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.where("toxic is not null").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(rows) == 905 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.98
    by_id = {r.doc_id: r for r in rows}
    assert by_id[None].predicted == 1 and all(by_id[i].predicted == 0 for i in (1001, 1002, 1003))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(r.predicted == 0 for r in rows)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = toxic_docs(spark)
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted((r.doc_id or -1, r.score) for r in toxicity.score_documents(docs, x).select("doc_id", "score").collect()) for x in (labels, other))
    assert one == two


def test_without_labels_or_rows_nothing_is_toxic(spark):
    docs, labels = toxic_docs(spark)
    assert toxicity.score_documents(docs, labels.limit(0)).where("predicted = 1").isEmpty()
    assert toxicity.score_documents(docs.limit(0), labels).collect() == []


# --- repeats -------------------------------------------------------------------------------


def brute_repeats(rows):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k:k + 20])
            if window in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("rows_at_once", [10, 1_000_000])
def test_repeated_windows_are_cut(spark, monkeypatch, rows_at_once):
    monkeypatch.setattr(repeats, "ROWS_AT_ONCE", rows_at_once)
    rnd = random.Random(6)
    words = ["a", "b", "c d", "é\xa0x", "long\u2003word", "e\n"]
    shared = [" ".join(rnd.choice(words) for _ in range(45)) for _ in range(6)]
    rows = [(i, " ".join(rnd.choice([rnd.choice(shared), f"own{i} " * rnd.randint(0, 30), f"u{rnd.random()}"]) for _ in range(5))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "same " * 5_000), (103, "same " * 19), (None, shared[0])]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, gone int")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeats.cut_repeats(docs).collect()}
    assert got == brute_repeats(rows)


def test_repeated_rows_lose_the_same_words(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (3, "x"), (3, text)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed, r.kept_text) for r in repeats.cut_repeats(docs, with_text=True).collect())
    assert got == [(1, 0, text), (1, 0, text), (2, 40, ""), (3, 0, "x"), (3, 40, "")]
    assert repeats.cut_repeats(docs.limit(0)).collect() == []


# --- leaks ---------------------------------------------------------------------------------


def brute_distance(item, words):
    row = [0] * (len(words) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(words, 1):
            new.append(min(row[j - 1] + (w != v), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("seed", range(30))
def test_best_match_is_the_least_edit_distance(seed):
    rng = np.random.default_rng(seed)
    item, words = rng.integers(0, 5, 12), rng.integers(0, 5, 30)
    distance, first, end = leaks.best_match(item, words)
    assert distance == brute_distance(item.tolist(), words.tolist()) == brute_distance(item.tolist(), words[first:end].tolist())


def test_edited_items_are_found_and_others_are_not(spark):
    rnd = random.Random(8)
    voc = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(rnd.choice(voc) for _ in range(rnd.randint(8, 60)))) for i in range(40)] + [(90, None), (91, " . ")]
    docs, planted = [], set()
    for i in range(300):
        words = [rnd.choice(voc) for _ in range(80)]
        if i % 2:
            item = rnd.randrange(40)
            part = items[item][1].split()
            for _ in range(int(0.2 * len(part))):
                at, kind = rnd.randrange(len(part)), rnd.randrange(3)
                part[at:at + (kind != 2)] = [rnd.choice(voc)] * (kind != 1)
            words[40:40] = [w.upper() + rnd.choice(["", ",", "."]) for w in part]
            planted.add((i, item))
        docs.append((i, "\n".join(words), "x"))
    docs += [(900, None, "x"), (901, "", "x"), (None, items[0][1], "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string, leaking string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = leaks.find_leaks(table, bench).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert len(found & planted) >= 0.97 * len(planted) and found - planted <= {(None, 0)} and (None, 0) in found
    assert all(r.distance <= 0.2 * r.item_words for r in got)
    left = leaks.drop_leaking(table, bench)
    assert left.columns == table.columns and {r.doc_id for r in left.collect()} == {d[0] for d in docs} - {i for i, _ in found}
    assert leaks.find_leaks(table.limit(0), bench).isEmpty() and leaks.find_leaks(table, bench.limit(0)).isEmpty()


@pytest.mark.parametrize("end", ["front", "back", "both"])
def test_long_items_with_edits_gathered_at_an_end_are_found(spark, end):
    rnd = random.Random(10)
    voc = [f"v{i}" for i in range(3_000)]
    items = [(i, " ".join(rnd.choice(voc) for _ in range(100 + 5 * i))) for i in range(41)]
    docs = []
    for i, text in items:
        part = text.split()
        edits = len(part) // 5
        at = {"front": range(edits), "back": range(len(part) - edits, len(part)), "both": [*range(edits // 2), *range(len(part) - edits // 2, len(part))]}[end]
        for k in at:
            part[k] = rnd.choice(voc)
        around = [[rnd.choice(voc) for _ in range(k)] for k in ((0, 0) if i % 3 == 0 else (40, 40))]
        docs.append((i, " ".join(around[0] + part + around[1])))
    got = leaks.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, i) for i, _ in items}
    assert all(0 <= r.first_word < r.end_word <= len(docs[r.doc_id][1].split()) and r.distance <= 0.2 * r.item_words for r in got)


def test_segments_hold_every_word():
    for n in range(1, 400):
        least, offsets = leaks.segments(n)
        assert {k for o in offsets for k in range(o, o + least)} == set(range(n))


def test_items_in_several_shards(spark, monkeypatch):
    monkeypatch.setattr(leaks, "SHARD_CHARS", 50)
    items = [(i, " ".join(f"i{i}w{k}" for k in range(12))) for i in range(9)]
    docs = spark.createDataFrame([(i, "before " + t + " after") for i, t in items], "doc_id long, text string")
    got = leaks.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.first_word, r.end_word, r.distance) for r in got) == [(i, i, 1, 13, 0) for i in range(9)]


# --- secrets -------------------------------------------------------------------------------

PATTERNS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile("[0-9a-f]+"), 0, 16),
]


def brute_base(text):
    found, counts = [], []
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        own = [m for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
        counts.append(len(own))
        found += [(m.start(), rank, kind, m.end()) for m in own]
    joined = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))
    return (*counts, hashlib.sha256(joined.encode()).hexdigest())


def test_fixed_patterns_and_random_strings(spark):
    rnd = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    random_string = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    roots = "config init connect param background worker transact buffer stream number account service handler request monitor session table index value order".split()
    words = [f"{a}_{b}" for a in roots for b in roots]
    rows = [(i, f"{rnd.choice(words)} api_key = '{random_string(24)}' {' '.join(rnd.choice(words) for _ in range(20))}") for i in range(400)]
    hidden = random_string(32)
    rows += [
        (500, f"see {hidden} here"), (501, "password: token: abcdefghijklmnop"), (502, None), (503, ""), (504, "é😀 API-KEY SECRET=abc.def-ghi_jkl= deadbeefdeadbeef0"),
        (505, "AKIA" + "B" * 14 + " AKIA1 " + "AKIAAKIA" + "C" * 9), (506, "f" * 20_000), (507, "background_worker_connect_index"), (507, "background_worker_connect_index"), (None, "token=abcdefghijkl"),
    ]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, assign string")
    got = secrets.find_secrets(docs).collect()
    assert len(got) == len(rows)
    want = sorted(((i, *brute_base(t)) for i, t in rows), key=repr)
    assert sorted([(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got], key=repr) == want
    spans = {r.doc_id: r.spans for r in got}
    assert spans[500] == "markov:4:36" and spans[507] == "" and spans[502] == spans[503] == ""
    assert not any("markov" in spans[i] for i in range(300))
    assert secrets.find_secrets(docs.limit(0)).collect() == []


def test_random_strings_behind_dots_and_slashes(spark):
    rnd = random.Random(19)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    random_string = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    roots = "config init connect param background worker transact buffer stream number account service handler request monitor session table index value order".split()
    words = [f"{a}_{b}" for a in roots for b in roots]
    rows = [(i, f"api_key = '{random_string(24)}' {' '.join(rnd.choice(words) for _ in range(20))}") for i in range(400)]
    a, b, c, whole = random_string(26), random_string(24), random_string(43), f"{random_string(20)}/{random_string(20)}"
    texts = {
        500: (f"https://example.com/d/{a}", [a]), 501: (f"https://hooks.example.com/services/T0/B0/{b}", [b]), 502: (f"key SG.{b}.{c} end", [b, c]),
        503: (f"jwt {a}.{b}.{c}", [a, b, c]), 504: (f"see {whole} here", [whole]), 505: ("file background_worker.connect_param_index.py", []),
        506: ("https://example.com/background_worker/connect_param_index", []),
    }
    docs = spark.createDataFrame(rows + [(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secrets.find_secrets(docs).where("doc_id >= 500").collect()}
    for i, (text, hidden) in texts.items():
        assert spans[i] == ",".join(f"markov:{text.index(x)}:{text.index(x) + len(x)}" for x in hidden), text


COMMON = """about account action address admin after again alert archive article author backup balance banner before between board branch bridge browser budget build button cache camera capital category center change
chapter charge check choice class client cloud coffee collect color comment common company complete config connect contact content copy corner country course cover create credit custom daily debate default delete design
detail device digital discount display document domain download driver early economy editor effect energy engine english error escape event example exchange export factory family feature field filter finance format forum
frame friend function future gallery garden general global graph group growth guide handle hardware health history holiday home hotel house human image import index industry info install island item journey kernel keyboard
knowledge label language launch layout learn library light limit local login machine magazine manage market master media member memory message method mobile model module money month morning native nature network news
notice number object office online option order origin output owner package page panel paper parent party password patient pattern payment people perfect phone photo picture place player plugin point policy portal power
press price privacy problem process product profile program project property provider public quality query question quick radio random range reader recent record region release remote report request research resource
result return review river robot school science screen script search season second section select series server service session setting shadow share simple single site small software source space special speed sport
spring square staff standard start state status stock storage store story stream street student studio style subject submit success summer support switch symbol system table target team template text theme ticket time
title today token topic total track traffic travel trend trial trust type unique update upload user value vector version video view village visit voice volume wallet water weather web website weekly white window winter wonder word work world write young zone""".split()


def test_urls_paths_and_names_stay_clean_and_random_strings_do_not(spark):
    rnd = random.Random(23)
    pick = lambda n, glue: glue.join(rnd.choice(COMMON) for _ in range(n))
    clean = {
        "dashed": lambda: f"https://www.example.com/{pick(4, '-')}.html", "slashed": lambda: f"https://example.org/{pick(4, '/')}/", "dated": lambda: f"https://example.org/{rnd.randint(2000, 2030)}/{rnd.randint(1, 12):02d}/{pick(4, '-')}",
        "path": lambda: f"/usr/local/{pick(3, '/')}/{pick(2, '_')}.py", "snake": lambda: pick(4, "_"), "joined": lambda: pick(3, ""), "package": lambda: f"src/main/java/org/apache/{pick(3, '/')}/Column",
    }
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    string = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    rows, kinds = [], {}
    for kind, make in clean.items():
        for _ in range(200):
            kinds[len(rows)] = kind
            rows.append((len(rows), f"see {make()} now"))
    for n in (24, 32, 40):
        for _ in range(100):
            kinds[len(rows)] = n
            rows.append((len(rows), f"see {string(n)} now"))
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select(F.col("doc_id") + 1_000_000, "text").unionByName(
        spark.createDataFrame(rows, "`(doc_id + 1000000)` long, text string")).toDF("doc_id", "text")
    got = secrets.find_secrets(docs).where("doc_id < 1000000").select("doc_id", "spans").collect()
    share = Counter(kinds[r.doc_id] for r in got if "markov" in r.spans)
    assert all(share[k] <= 2 for k in clean), share
    assert all(share[n] >= 97 for n in (24, 32, 40)), share


def test_pairs_that_no_class_has_seen_weigh_little():
    ordinary = {(a, b): 500 for a in "aeiou" for b in "bcdfgklmnprst"} | {(b, a): 400 for a in "aeiou" for b in "bcdfgklmnprst"}
    rare = {(a, b): 1 for a, b in zip("abcdefghij0123456789", "1q2w3e4r5t6y7u8i9o0p")}
    w = secrets.chain_weights({True: rare, False: ordinary})
    assert w["q", "x"] < 3 and w["a", "n"] < 0 and w["a", "7"] > 3 and w["_", "-"] == pytest.approx(0, abs=0.7)
    assert {(a, b) for a, b in w if "/" in (a, b)} == set()
    assert set(secrets.chain_weights({True: {}, False: {}}).values()) == {0.0}


def test_secret_scan_runs_no_python(spark):
    plan = secrets.op6_secret_scan(spark, FOLDER)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- urls ----------------------------------------------------------------------------------


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def brute_rule(host, path):
    best = None
    for h, p, said in urls.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, said)
    return best or (None, None)


def test_url_parts_and_rules(spark):
    listed = [
        None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/7x?q#f", "x://com/en/", "http://xcom/en/", "a://b://c.com/en/", "http://www.example.net/de/81", "http://org?x/es/",
        "http://org/es/", "http://example.net/de/7", "http://ÄB.com/EN/", "http://h.com#/en/", "http://h.com/en", "http://h\n.com/en/\nx", "http://" + "ab" * 5_000 + ".com/en/",
    ] * 2
    html = "<p>the ring and the sun</p> the ring"
    pages = spark.createDataFrame([(i, u, html, "x") for i, u in enumerate(listed)] + [(None, "http://com/en/", None, None)], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in urls.judge_urls(pages).collect()}
    assert len(got) == len(listed) + 1 and got[None].verdict == "block"
    for i, url in enumerate(listed):
        host, path = brute_parts(url)
        rule, said = brute_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == (said or ("block" if got[i].block_odds > 0 else "allow"))
    assert urls.judge_urls(pages.limit(0)).collect() == []


def test_names_fall_into_their_most_probable_words():
    model = {w: np.log(p) for w, p in {"the": 0.3, "ring": 0.2, "ther": 0.01, "ing": 0.05, "sun": 0.1}.items()}
    assert urls.segment("thering", model) == ["the", "ring"] and urls.segment("sunthe", model) == ["sun", "the"]
    assert urls.segment("qqq", model) == ["qqq"] and urls.segment("", model) == []


def test_bayes_learns_the_rules_from_other_urls(spark):
    rnd = random.Random(3)
    good, bad = ["ring", "sun", "the"], ["spam", "win", "cash"]
    rows = []
    for i in range(600):
        block = i % 2 == 0
        host = "".join(rnd.choice(bad if block else good) for _ in range(3))
        rows.append((i, f"http://{host}.{'org/es' if block else 'net/de'}/{i}", " ".join(good + bad)))
    rows += [(1_000 + i, f"http://{''.join(rnd.choice(bad if i % 2 else good) for _ in range(2))}.xyz/", "") for i in range(100)]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).where("rule is null").collect()
    assert np.mean([(r.verdict == "block") == bool(r.page_id % 2) for r in got]) > 0.95


def brute_split(name, counts, total):
    """All splits of a short name, the most probable first."""
    best = (-math.inf, [])
    for cuts in itertools.product([False, True], repeat=len(name) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(name)]
        words = [name[a:b] for a, b in zip([0, *ends], ends)]
        value = sum(math.log(counts[w] / total) if w in counts else -math.log(1e4) - len(w) * math.log(10) for w in words)
        best = max(best, (value, words), key=lambda x: x[0])
    return best


def test_verdicts_are_those_of_a_plain_bayes(spark):
    rnd = random.Random(12)
    words = ["ring", "sun", "the", "cash", "win", "spam", "sing", "there"]
    text = {i: " ".join(rnd.choice(words) for _ in range(30)) + " longertailword" for i in range(900)}
    rows = []
    for i in range(900):
        # one allowed url for eight blocked ones; the path's first part tells nothing
        block = i % 9 != 0
        host = "".join(rnd.choice(words[3:] if block else words[:4]) for _ in range(2))
        end = rnd.choice([("org", "es"), ("com", "en")]) if block else ("net", "de")
        rows.append((i % 880, f"http://shop.{host}.{end[0]}/{end[1]}/item/{rnd.randint(1, 9999)}", text[i]))
    rows += [(2_000 + i, f"http://shop.{''.join(rnd.choice(words) for _ in range(2))}.xyz/zz/item/{rnd.randint(1, 9999)}", None) for i in range(300)]
    rows += [(3_000 + i, "http://longertailword.xyz/new/part", None) for i in range(3)]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    counts = Counter(w for _, _, t in rows for w in re.findall("[a-z]+", t or ""))
    total, tokens, split = sum(counts.values()), [], {}
    for _, url, _ in rows:
        host, path = brute_parts(url)
        own = []
        for label in host.split("."):
            if label not in split:
                split[label] = brute_split(label, counts, total)[1] if len(label) < 14 else [label]
            own += [f"h:{w}" for w in split[label]]
        own += [f"p:{len(x)} digits" if x.isdigit() else f"p:{x}" for x in re.findall("[a-z0-9]+", path)]
        tokens.append((host, path, brute_rule(host, path)[1], own))
    seen = {k: Counter(t for *_, said, own in tokens if said == k for t in own) for k in ("block", "allow")}
    both = seen["block"] + seen["allow"]
    size = {k: sum(c.values()) for k, c in seen.items()}

    def weight(t):
        if t not in both:
            return 0.0
        prior = len(both) * both[t] / sum(both.values())
        return math.log((seen["block"][t] + prior) / (size["block"] + len(both))) - math.log((seen["allow"][t] + prior) / (size["allow"] + len(both)))

    want = {(host, path): sum(map(weight, own)) for host, path, _, own in tokens}
    assert size["block"] > 7 * size["allow"] and abs(weight("h:shop")) < 0.02 and abs(weight("p:item")) < 0.02
    for r in got:
        assert r.block_odds == pytest.approx(want[r.host, r.path], abs=1e-9)
        assert r.verdict == (brute_rule(r.host, r.path)[1] or ("block" if r.block_odds > 0 else "allow"))
    undecided = [r for r in got if r.rule is None and r.page_id < 3_000]
    assert 0.2 < np.mean([r.verdict == "block" for r in undecided]) < 0.95
    assert {r.block_odds for r in got if r.page_id >= 3_000} == {0.0} and {r.verdict for r in got if r.page_id >= 3_000} == {"allow"}


def test_of_equally_long_rules_one_is_taken_and_hosts_of_any_size_are_split(spark, monkeypatch):
    monkeypatch.setattr(urls, "URLS_PER_SALT", 3)
    monkeypatch.setattr(urls, "HOSTS_AT_ONCE", 2)
    rows = [(i, "http://thering.com/a", "the ring") for i in range(20)] + [(i, f"http://h{i}ring.com/a", None) for i in range(20)]
    rules = [("com", "/a", "block"), ("com", "/a", "block"), ("ring.com", "/b", "allow")]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), rules).collect()
    assert sorted(r.page_id for r in got) == sorted(r[0] for r in rows) and {r.rule for r in got} == {"com/a"} and {r.verdict for r in got} == {"block"}
    assert {r.block_odds for r in got} == {0.0}


# --- licences ------------------------------------------------------------------------------


def test_notices_are_named_and_prose_is_left_alone(spark):
    prose = [f"The river {w} ran past the old mill and nobody spoke of it for {i} days." for i, w in enumerate("slowly calmly quickly darkly brightly".split() * 60)]
    rows = [(i, f"{prose[i]}\n{prose[i + 1]}") for i in range(200)]
    rows += [
        (300, prose[0] + "\nLicensed under the Apache License, Version 2.0.\n" + prose[1]), (301, "Released under the MIT License."),
        (302, "this work is licensed under the gnu general public license, version 3"), (303, "Licensed under CC BY-NC 4.0."), (304, None), (305, ""),
        (306, " ".join(prose[:20]) + " Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files " + " ".join(prose[:9])),
        (307, "\n \n"), (301, "Released under the MIT License."), (None, "SPDX-License-Identifier: MPL-2.0"), (308, "word " * 50_000),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, family string")
    got = licences.find_licences(docs).collect()
    named = sorted([(r.doc_id, r.family) for r in got if r.family != "unknown"], key=repr)
    assert named == sorted([(300, "apache-2.0"), (301, "mit"), (301, "mit"), (302, "gpl"), (303, "cc-by-nc"), (306, "mit"), (None, "mpl-2.0")], key=repr)
    assert sum(r.family == "unknown" for r in got) <= 4 and all(r.first_word < r.end_word for r in got)
    assert licences.find_licences(docs.limit(0)).collect() == []


def test_altered_notices_of_every_family_held_out():
    model = licences.train([f"plain line {i} about the weather and the hills" for i in range(300)])
    rng = np.random.default_rng(77)
    right = total = 0
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            for _ in range(5):
                words = licences._altered(text, rng, ["acme", "north", "works"])
                hits = model.scan(licences._WORDS.of(words), [(0, len(words))])
                right += any(h[2] == family for h in hits)
                total += 1
    assert right / total > 0.85


@pytest.fixture(scope="module")
def licence_model():
    """Trained on half of the plain lines of the delivered texts; the words of the other half are for the tests."""
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{FOLDER}/documents.parquet", columns=["text"]).column("text").to_pylist()
    plain = [x for t in texts for x in (t or "").split("\n") if x.strip() and not re.search("licen[cs]|copyright|permi(t|ss)|public domain|rights reserved", x.lower())]
    random.Random(4).shuffle(plain)
    return licences.train([x[:400] for x in plain[:1_500]]), plain[1_500:5_000]


def licence_hits(model, words):
    return model.scan(licences._WORDS.of(words), [(0, len(words))])


def test_every_template_is_found_inside_a_long_line(licence_model):
    model, plain = licence_model
    rnd, prose = random.Random(6), [w for x in plain for w in x.split()]
    for family, texts in [*licences.TEMPLATES.items(), ("unknown", licences.UNKNOWN)]:
        for text in texts:
            found = 0
            for _ in range(40):
                notice = text.replace("{name}", rnd.choice(["Acme", "Northwind Traders"])).replace("{number}", "2").split()
                at = rnd.randrange(len(prose) - 60)
                words = prose[at:at + 30] + notice + prose[at + 30:at + 60]
                hits = [h for h in licence_hits(model, words) if h[2] == family]
                found += any(h[0] < 30 + len(notice) and h[1] > 30 for h in hits)
            assert found >= 38, (family, text, found)


def test_plain_lines_have_no_notices(licence_model):
    model, plain = licence_model
    flagged = [x for x in plain if licence_hits(model, x.split())]
    assert len(flagged) <= 0.005 * len(plain)
    # nor have runs of one word, and a named notice takes the place of an unknown one that it overlaps
    assert licence_hits(model, ["under"] * 500) == []
    hits = licence_hits(model, "All of this is Licensed under the Acme License. Licensed under the Mozilla Public License, version 2.0.".split())
    assert "mpl-2.0" in {h[2] for h in hits} and all(a[1] <= b[0] for a, b in zip(hits, hits[1:]))


def test_spots_of_templates_match_a_plain_search():
    rnd = random.Random(2)
    template = licences.Template.of("x", "a b c d e f")
    for _ in range(200):
        words = [rnd.choice("abcdefz") for _ in range(rnd.randint(1, 40))]
        hashed = licences._WORDS.of(words)
        codes = licences.pair_codes(hashed)
        got = template.spots(codes, np.arange(len(codes)))
        places = [i for i, p in enumerate(zip(words, words[1:])) if "".join(p) in "abcdef"]
        # three of the five pairs within eight places
        near = any(sum(i <= j < i + 8 for j in places) >= 3 for i in places)
        assert bool(got) == near
        assert template.likeness(hashed) == len({"".join(p) for p in zip(words, words[1:]) if "".join(p) in "abcdef"}) / 5
