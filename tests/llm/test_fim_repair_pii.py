"""Fill-in-middle, conversation repair and personal data against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import fim, pii, role_repair
from tests.conftest import SF_SMALL
from tests.llm.test_operators import DOCS, ODD

NULLS_LAST = lambda r: str(r)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    more = [(20, "a <P> mark", "en", "a"), (21, "<", None, None), (22, "ends <P", "en", "a"), (23, "😀" * 40 + "<M", "en", "a")]
    return spark.createDataFrame(ODD + more, DOCS).withColumns({
        "form": F.lit("clash"), "spans": F.lit(1), "k1": F.lit(2), "h": F.lit(3), "t": F.lit("x")})


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def brute_fim(i, t):
    t = t or ""
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not t or re.search("<[PSM]>", t) or h3 % 100 >= 90:
        return (i, len(t), "plain", None, None, sha(t), sha(t)), t
    pre, mid, suf = t[:a], t[a:b], t[b:]
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return (i, len(t), form, a, b - a, sha(out), sha(t)), out


@pytest.mark.parametrize("unit", [3, fim.UNIT])
def test_fill_in_middle(spark, odd, small, unit):
    for docs in (odd, small):
        rows = docs.select("doc_id", "text").collect()
        want = [brute_fim(r.doc_id, r.text if docs is odd else r.text[:]) for r in rows]
        got = fim.fill_in_middle(docs, unit=unit if docs is odd else fim.UNIT, outputs=True).collect()
        assert sorted((str((*w, o)) for w, o in want)) == sorted(str(tuple(r)) for r in got)
        for r in got:
            assert sha(fim.restored_text(r.output, r.form)) == r.restored_sha256
    assert {w[0][2] for w in want} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(odd.filter("doc_id < 0")).count() == 0


def test_fill_in_middle_shuffles_once(small):
    plan = fim.fill_in_middle(small)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_hot_row_is_spread(spark):
    docs = spark.range(600, numPartitions=6).select(F.lit(5).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    assert fim.pieces(docs).select("k1", "k2").distinct().count() == 6
    got = fim.fill_in_middle(docs).distinct().collect()
    assert [tuple(r) for r in got] == [brute_fim(5, "same text")[0]] and fim.fill_in_middle(docs).count() == 600


LEGAL = re.compile(r"(s?(ua)+)?\Z")


def brute_repair(rows):
    """All edits of ``(initial, fault)`` rows with at most two insertions in a place."""
    gaps = ["".join(p) for k in range(3) for p in itertools.product("ua", repeat=k)]
    best = None
    choices = []
    for x, fault in rows:
        own = [("D", "", 3)]
        if fault < 2:
            own += [("K", x, fault)] if x and x in "sua" else []
            own += [("R", "u", 2 + fault), ("R", "a", 2 + fault)]
        choices.append(own)
    for pick in itertools.product(*choices):
        for put in itertools.product(gaps, repeat=len(rows) + 1):
            cost = sum(p[2] for p in pick) + 2 * sum(map(len, put))
            if best and cost > best[0]:
                continue
            if LEGAL.match(put[0] + "".join(p[1] + g for p, g in zip(pick, put[1:]))):
                audit = "I" * len(put[0]) + "".join(p[0] + "I" * len(g) for p, g in zip(pick, put[1:]))
                best = min(best or (cost, audit), (cost, audit))
    return best


def parsed(rows):
    stack, seen = role_repair.Stack(), []
    for x, fault in reversed(rows):
        seen.append((stack.read(x, fault), *stack.best()))
    walk, audit, roles = role_repair._Walk(), "", ""
    for (x, _), (edges, top, _) in zip(rows, reversed(seen)):
        for edit, role, _ in walk.row(x, "", edges, top):
            audit, roles = audit + edit, roles + (role or "")[:1]
    for edit, role, _ in walk.end():
        audit, roles = audit + edit, roles + role[:1]
    assert LEGAL.match(roles)
    return (seen[-1][2] if seen else 0), audit


def test_parser_matches_all_edits():
    rng = random.Random(7)
    for _ in range(250):
        rows = [(rng.choice(["s", "u", "a", "u", "a", "x", ""]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 3))]
        assert parsed(rows) == brute_repair(rows), rows


def oracle(df, view, sql, path):
    df.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    found = con.sql(sql)
    return found.columns, sorted(map(str, found.fetchall()))


def test_repair_matches_sql(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, 0, 1, 2, 3, 4, 9]),
             rng.choice([None, "system", "user", "assistant", "user", "assistant", "tool", ""]),
             rng.choice([None, "", " \n", "Ok.", "Ok", "Yes! ", "No?\n", "b", "c." * 3000])) for _ in range(260)]
    rows += [(500, 1, "user", "same")] * 40 + [(501, i, "user" if i % 2 else "assistant", f"turn {i}.") for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .withColumns({"cost": F.lit("clash"), "copies": F.lit(9), "c": F.lit(1), "h": F.lit(2)})
    got = role_repair.repair_digest(role_repair.damaged(df))
    cols, want = oracle(df, "conversations", role_repair.REPAIR_SQL, str(tmp_path / "c"))
    assert sorted(str(tuple(r[c] for c in cols)) for r in got.collect()) == want
    assert role_repair.repair_digest(role_repair.damaged(df.filter("turn < -5"))).count() == 0
    out = role_repair.repair(df).orderBy("conv_id", "place").collect()
    by = {}
    for r in out:
        by.setdefault(r.conv_id, []).append(r)
    assert all(LEGAL.match("".join(r.role[:1] for r in v)) for v in by.values())
    assert all([r.place for r in v] == list(range(len(v))) for v in by.values())
    kept = [r for r in by[501] if r.edit == "K"]
    assert len(kept) == 300 and kept[0].text == "turn 0."


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(d))) % 10 == 0


def base_spans(t):
    out = []
    tests = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 14 <= len(re.sub("[ -]", "", v)) <= 19 and luhn(re.sub("[ -]", "", v))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 10 <= len(re.sub("[^0-9]", "", v)) <= 15)]
    for rank, (kind, pattern, ok) in enumerate(tests):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, t, re.ASCII) if ok(m[0])]
    return [(k, s, e) for s, _, e, k in sorted(out)]


HARD = ["Call Zebedee Quill at zq@mail.example.org. or zq@mail.example.org_d@e.fg x",
        "again Zebedee Quill, zq@mail.example.org: see 10.0.300.1 1.2.3.4.5.6.7.8",
        "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 41111111111111111111 12  3",
        "+1 (017) 555-7713 +44.20.7946.0958- +1 2 über@x.com fooübar@x.com.y. é😀 +99 123456789012",
        "a@b", "@@a@b.c@d.e@f.g", "Zebedee Quill, zq@mail.example.org wrote", "0255.0000255.1.2 x 256.1.1.1 1.1.1" + "1" * 50,
        "1 " * 5000 + "x@y.zz", "a" * 50_000 + "@" + "b" * 50_000, "+1" * 3000, "4111111111111111" * 9, "a.b@" * 400 + "c.d"]


def test_private_spans(spark, small, odd, tmp_path):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(HARD + HARD[:2])]
                                  + [(100 + i, f"plain words {i} here x@y.zz") for i in range(60)], "doc_id long, text string")
    for docs in (texts.withColumns({"spans": F.lit(1), "h": F.lit(2), "kind": F.lit("z")}), small, odd):
        for r in docs.select("doc_id", "text").join(pii.private_spans(docs).distinct(), "doc_id").collect() if docs is not odd else []:
            base = base_spans(r.text or "")
            assert r.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for k, s, e in base)), (r.doc_id, r.spans)
            n = Counter(k for k, _, _ in base)
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in pii.KINDS)
            assert [x for x in r.spans.split(",") if x and not x.startswith("term")] == [f"{k}:{s}:{e}" for k, s, e in base]
    assert pii.private_spans(odd).count() == odd.count()
    assert pii.private_spans(texts.filter("doc_id < 0")).count() == 0
    cols, want = oracle(texts, "documents", pii.PII_SQL, str(tmp_path / "t"))
    got = pii.private_spans(texts)
    assert sorted(str(tuple(r[c] for c in cols)) for r in got.collect()) == want
    terms = {r.doc_id: r.spans for r in got.collect()}
    assert terms[0].startswith("term:5:12,term:13:18,email:") and "term" not in terms[120]


def test_terms_match_brute_force(spark):
    """Names that stand by one address are found; common words and names of many are not."""
    rng = random.Random(2)
    words = [f"word{i}" for i in range(50)]
    docs, n = [], 0
    for person in range(12):
        for _ in range(4):
            around = [rng.choice(words) for _ in range(6)]
            docs.append((n, f"{' '.join(around[:3])} Name{person} Sure{person}x p{person}@mail.org {' '.join(around[3:])}"))
            n += 1
    for i in range(200):
        docs.append((n + i, " ".join(rng.choice(words) for _ in range(12)) + (f" Sure{i % 12}x" if i < 12 else "")))
    got = {r.doc_id: r.spans for r in pii.private_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    sets = [set(re.findall(r"\w+", t)) for _, t in docs]
    for i, t in docs:
        marked = {t[int(s):int(e)] for k, s, e in (x.split(":") for x in got[i].split(",") if x) if k == "term"}
        want = set()
        for w in set(re.findall(r"\w+", t)):
            df = sum(w in s for s in sets)
            for person in range(12):
                co = sum(w in s for s, (_, u) in zip(sets, docs) if f"p{person}@" in u)
                if co >= 2 and 5 * co >= 4 * df and co * len(docs) >= 8 * df * 4 and not w.startswith(f"p{person}") \
                        and w not in ("mail", "org"):
                    want.add(w)
        assert marked == want, (i, marked, want)
    assert "term" in got[0] and "term" in got[n]


def test_sanitised_texts(spark):
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(HARD[:4])] + [(9, None, "k")]
                               + [(100 + i, f"plain words {i}", "k") for i in range(40)], "doc_id long, text string, h string")
    out = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert pii.sanitised(df).columns == df.columns and out[9] is None and out[100] == "plain words 0"
    assert out[0] == "Call   at <EMAIL>. or <EMAIL><EMAIL> x" and out[2].startswith("card <CARD> and 4111-1111-1111-1112")


def test_private_spans_use_no_python(small):
    plan = pii.private_spans(small)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
