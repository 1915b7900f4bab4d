from __future__ import annotations

import hashlib
import random
import re

import pytest

from tidemark.llm import personal, workload

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, d in enumerate(reversed(number)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind, value):
    number = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(number) <= 19 and luhn(number)
    return kind == "email" or 10 <= len(number) <= 15


def base(text):
    text = text or ""
    found = [
        (m.start(), i, kind, m.end())
        for i, (kind, p) in enumerate(PATTERNS.items())
        for m in re.finditer(p, text)
        if good(kind, m[0])
    ]
    kinds = [k for _, _, k, _ in found]
    joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))
    return (*(kinds.count(k) for k in PATTERNS), hashlib.sha256(joined.encode()).hexdigest()), joined


def odd_texts():
    rng = random.Random(6)
    parts = ["a", "b.c", "_d", "@", ".", "x-y", "%", "+", "12", "255", "0", "4111111111111111", "4111 1111 1111 1111", " ", "-", "(555)", "é", "🙂", "\n", "1.2.3.4", "+1 (555) 123-4567"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    return [None, "", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8.9", "0000000255.1.1.1", "1.2.3.256", "9" * 5000, "a" * 20_000 + "@", "1.2.3." * 500, "+" * 300, *made]


def test_base_spans_equal_the_patterns(spark):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, row string").repartition(4)
    rows = {r.doc_id: r for r in personal.scan(df).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        r = rows[i]
        want, joined = base(text)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == want, text
        assert set(filter(None, joined.split(","))) <= set(filter(None, r.spans.split(",")))


def test_contexts_reveal_unseen_identifiers(spark):
    rows = [(i, f"pad {i} words here, reach me at user{i}@mail.example.com today") for i in range(12)]
    rows += [(100, "so reach me at hidden-handle-7 today"), (101, "\n (reach me at hidden-handle-7.)")]
    rows += [(200 + i, f"look at word{i} and stay at {i}") for i in range(30)] + [(300, None), (301, "")]
    rows += [(5, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.spans, r.n_found) for r in personal.scan(df).collect()}
    assert found[100] == ("email:15:30", 1)
    assert found[101] == ("email:15:30", 1)
    assert all(n == 0 for doc, (_, n) in found.items() if doc not in (100, 101))
    assert found[300] == found[301] == ("", 0)
    assert personal.scan(df).count() == len(rows)
    assert personal.scan(df.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in workload.op2_personal(spark, folder).collect()}
    assert rows == {d.doc_id: base(d.text)[0] for d in docs}


@pytest.mark.parametrize("bound", [0, 50_000])
def test_no_context_is_left_out(spark, monkeypatch, bound):
    """Contexts beyond those that are broadcast reveal values as well."""
    monkeypatch.setattr(personal, "BROADCAST", bound)
    rows = [(100 * c + i, f"pad words here ctx{c} reach{c} user{c}x{i}@mail.example.com today") for c in range(7) for i in range(5 + c)]
    rows += [(1000 + c, f"so ctx{c} reach{c} hidden-{c} today") for c in range(7)]
    found = {r.doc_id: r.n_found for r in personal.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: n for d, n in found.items() if n} == {1000 + c: 1 for c in range(7)}


def trimmed(token):
    number = token.rstrip(personal.EDGES).lstrip(personal.EDGES.replace("(", ""))
    return number if re.match(r"\([0-9]+\).*[0-9]$", number) else token.strip(personal.EDGES)


def bootstrap(rows):
    """All spans of each row by plain loops, without dropping any candidate beforehand."""
    run, separator = re.compile(personal.RUN, re.ASCII), re.compile(personal.SEPARATOR)
    seeds, held, pieces = {}, {}, []
    based = [sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in base(t)[1].split(",") if x)) for _, t in rows]
    spans = [list(x) for x in based]
    for (_, text), found in zip(rows, based, strict=True):
        for start, end, kind in found:
            before = separator.split(text[:start])
            if len(before) > 2 and " ".join(before[-3:-1]).strip(" "):
                context = " ".join(before[-3:-1]).lower()
                seeds.setdefault((context, kind), set()).add(text[start:end].lower())
                held.setdefault(context, {}).setdefault(trimmed(text[start:end]).lower(), set()).add(kind)
        whole, at = [], 0
        for m in [*separator.finditer(text or ""), None]:
            end = m.end() if m else len(text or "")
            whole.append((at, (text or "")[at:end]))
            at = end
        pieces.append(whole)
    known = {key for key, values in seeds.items() if len(values) >= personal.SUPPORT}
    contexts = {c for c, _ in known}
    places, values = [], {}
    for row, whole in enumerate(pieces):
        words = [separator.sub("", w) for _, w in whole]
        for i in range(2, len(words)):
            context = " ".join(words[i - 2 : i]).lower()
            if context in contexts:
                token = words[i]
                if re.match(r"[^A-Za-z]*[0-9]", token):
                    m = run.match("".join(w for _, w in whole[i : i + personal.NUMBER_WORDS]))
                    token = m[0] if m and m[0] else token
                value = trimmed(token)
                if value:
                    places.append((row, whole[i][0] + token.index(value), context, value))
                    values.setdefault(context, set()).add(value.lower())
    edges = {}
    for context, kind in known:
        mine = {}
        for v in values.get(context, ()):
            kinds = held[context].get(v)
            if kinds is None or kind in kinds:
                mine[v] = kinds is not None
        if mine and sum(mine.values()) / len(mine) >= personal.PLAUSIBLE:
            edges[context, kind] = mine
    belief = {}
    for (_, kind), mine in edges.items():
        for v, seed in mine.items():
            belief[kind, v] = max(belief.get((kind, v), 0.0), float(seed))
    sown = {k for k, b in belief.items() if b}
    for _ in range(personal.TURNS):
        worth = {key: sum(belief[key[1], v] for v in mine) / len(mine) for key, mine in edges.items()}
        doubt = {}
        for key, mine in edges.items():
            for v in mine:
                doubt[key[1], v] = doubt.get((key[1], v), 1.0) * max(1 - worth[key], 1e-9)
        belief = {k: 1.0 if k in sown else 1 - d for k, d in doubt.items()}
    best = {}
    for (kind, v), b in belief.items():
        if b >= personal.BELIEVED and (kind, v) not in sown:
            rank = (bool(re.fullmatch(r"[0-9() .+-]+", v)) == (kind != "email"), b, -personal.KINDS.index(kind))
            best[v] = max(best.get(v, (rank, kind)), (rank, kind))
    for row, start, context, value in places:
        kind = best.get(value.lower(), (0, None))[1]
        span = (start, start + len(value), kind)
        if (context, kind) in edges and span not in spans[row] and not any(s < span[1] and start < e for s, e, _ in based[row]):
            spans[row].append(span)
    return [",".join(f"{k}:{s}:{e}" for s, e, k in sorted(x, key=lambda t: (t[0], personal.KINDS.index(t[2])))) for x in spans]


def contexts_corpus():
    """Texts in which some word pairs stand before identifiers mostly, some often, some seldom; identifiers known and hidden."""
    rng = random.Random(12)
    pairs = [f"pre{i} key{i}" for i in range(9)]
    known = lambda: rng.choice([f"u{rng.randrange(400)}@mail.example.com", f"10.1.{rng.randrange(200)}.7", f"+1 (555) 123-{rng.randrange(1000, 9999)}", "4111 1111 1111 1111"])
    hidden = [*(f"handle-{i}" for i in range(6)), *(f"555 0{i}99 77" for i in range(6)), *(f"(see 019{i} 2233)" for i in range(4))]
    rows = []
    for i in range(260):
        words = []
        for _ in range(rng.randint(0, 12)):
            words += [f"w{rng.choice('abcdef')}{rng.choice('ghijk')}" for _ in range(rng.randint(0, 5))]
            pair = rng.randrange(9)
            words.append(pairs[pair].upper() if rng.random() < 0.2 else pairs[pair])
            chance = rng.random() * 9
            words.append(known() if chance > pair + 2 else rng.choice(hidden) if chance > pair else f"plain{rng.randrange(60)}")
            words.append(rng.choice(["", ".", "\n", "and", "é🙂"]))
        rows.append((i, " ".join(words)))
    long = "x" * 700 + " " + "y" * 5000
    return [*rows, (900, None), (901, ""), (902, f"{long} pre0 key0 handle-1"), (903, f"{long} a{'b' * 300} {'c' * 4500} u5@mail.example.com")]


@pytest.mark.parametrize("classes", [1, 3, 16])
def test_equals_plain_bootstrapping(spark, monkeypatch, classes):
    monkeypatch.setattr(personal, "CLASSES", classes)
    rows = contexts_corpus()
    got = {r.doc_id: (r.spans, r.n_found) for r in personal.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert {i: s for i, (s, _) in got.items()} == {i: s for (i, _), s in zip(rows, bootstrap(rows), strict=True)}
    assert sum(n for _, n in got.values()) > 50


def test_equals_plain_bootstrapping_on_the_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {r.doc_id: r.spans for r in workload.op2_personal(spark, folder).collect()}
    assert got == {i: s for (i, _), s in zip(rows, bootstrap(rows), strict=True)}


def test_planted_identifiers_are_recalled(spark):
    """Of identifiers no pattern fits, behind contexts of known ones: found, and of all that is found: planted."""
    rng = random.Random(3)
    words = lambda n: " ".join("w" + "".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(n))
    contexts = ["contact us at", "my account is", "kindly write to", "the login was"]
    rows, planted = [], set()
    for i in range(400):
        context = rng.choice(contexts)
        if rng.random() < 0.35:
            value = f"member-{rng.randrange(60)}"
            planted.add(i)
        else:
            value = f"user{i}@mail.example.com"
        rows.append((i, f"{words(rng.randint(5, 60))} {context} {value} {words(rng.randint(5, 60))}"))
    found = {r.doc_id for r in personal.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.n_found}
    assert found == planted


def test_a_context_has_all_its_kinds(spark):
    """Phones in a context of more emails; an unseen value that phones' own context shows too is a phone."""
    rows = [(i, f"pad {i} words, contact me at user{i}@mail.example.com today") for i in range(12)]
    rows += [(100 + i, f"pad {i} words, contact me at +1555010{i:04d} today") for i in range(8)]
    rows += [(200 + i, f"pad {i} words, please ring +1555020{i:04d} today") for i in range(8)]
    rows += [(300, "so contact me at 555-0199-77 today"), (301, "so please ring 555-0199-77 today"), (302, "so contact me at hidden-handle today")]
    found = {r.doc_id: (r.spans, r.n_found) for r in personal.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[300] == ("phone:17:28", 1)
    assert found[301] == ("phone:15:26", 1)
    assert found[302] == ("email:17:30", 1)
    assert all(n == 0 for doc, (_, n) in found.items() if doc < 300)


def test_values_of_several_words_are_whole(spark):
    """Phones with spaces are seeds of their context, and unseen ones without a country code get whole spans."""
    phones = [f"+1 ({100 + i}) 555-77{i:02d}" for i in range(12)]
    rows = [(i, f"pad {i} words, ring us at {p}. Or come by 25 times") for i, p in enumerate(phones)]
    rows += [(40, "now ring us at (017) 555-7713, or not"), (41, "now ring us at (see 017 555 7714) today"), (42, "now ring us at 017 555 7715\n2024 was")]
    rows += [(43, "now (ring us at (019) 555-7716) today")]
    rows += [(50 + i, f"host {i} seen from at 10.0.0.{i} 200 512") for i in range(6)]
    found = {r.doc_id: (r.spans, r.n_found) for r in personal.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[40] == ("phone:15:29", 1)
    assert found[42] == ("phone:15:27", 1)
    assert found[43] == ("phone:16:30", 1)
    assert all(n == 0 for doc, (_, n) in found.items() if doc < 40 or doc >= 50)
