"""The ten operators against brute force, on odd rows and on the small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import (chat, fingerprints, lang_id, minhash, mixing, packing, substring_dedup,
                          token_counts, token_files, vector_dedup)
from lakeloom.llm.fm_index import FmIndex
from lakeloom.llm.tokens import Encoder, known_path
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 700}" for i in range(9000))
SHARED = " ".join(f"s{i}" for i in range(60))
# null, empty, blank, long, repeated rows, ties of doc_id, null columns
ODD = [(1, "one two three", "en", "a"), (1, "another text with one id", "en", None), (2, None, None, "a"),
       (3, "", "en", "b"), (4, " \n\t ", "fr", "b"), (5, LONG, "fr", "b"), (6, "x " + SHARED, "en", "c"),
       (7, SHARED + " tail", "en", "c"), (8, "same row", "en", "a"), (8, "same row", "en", "a"),
       (None, "no id here " + SHARED, None, None), (9, LONG, "fr", "a"), (10, "é" * 30 + " 123 ...", "fr", "a")]
DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    # extra columns whose names clash with those the operators add
    return spark.createDataFrame(ODD, DOCS).withColumns({
        "n_chars": F.length("text").cast("long"), "size": F.lit("clash"), "kept": F.lit(1), "score": F.lit("x")})


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS + ", n_chars long")


def ids_of(name, text):
    return Encoder(known_path(name))._ids([text or ""])[0]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_near_dedup_matches_brute_force(spark, small, odd, empty):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    sets = {i: Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) for i, t in rows if (w := WORD.findall(t or ""))}
    inverse = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            inverse[g].add(i)
    root = {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for j, n in Counter(j for g in s for j in inverse[g] if j > i).items():
            both = set(s) | set(sets[j])
            prob = sum(1 / sum(max(s[h] / s[g], sets[j][h] / sets[j][g]) for h in both) for g in set(s) & set(sets[j])) \
                if n > 0.3 * len(both) else 0
            if max(n / len(both), prob) >= 0.8:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(small).collect()}
    assert got == {i: top(i) for i, _ in rows}
    out = minhash.near_duplicates(odd).collect()
    assert len(out) == len(ODD)
    classes = {r.doc_id: r.class_id for r in out if r.doc_id not in (1, None)}
    assert classes[9] == 5 and classes[3] == 3 and classes[2] == 2 and classes[8] == 8
    kept = minhash.one_of_each(odd)
    assert kept.columns == odd.columns and Counter(r.doc_id for r in kept.collect())[8] == 1
    assert minhash.near_duplicates(empty).count() == 0 and minhash.one_of_each(empty).count() == 0


def test_near_copies_of_a_large_group_are_linked(spark):
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(300):
        w = list(base)
        w[(7 * i) % 120] = f"x{i}"                 # neighbours in the group: about 0.84
        rows.append((i, " ".join(w)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


def test_near_copies_with_repeated_lines_are_linked(spark):
    rows = []                                   # half of a text once and m times: plain Jaccard 0.96
    for i in range(40):
        w = [f"t{i}w{k}" for k in range(200)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:100] * (3, 4, 5, 10)[i % 4] + w[100:]))]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: i - i % 2 for i in range(80)}


def test_packing(spark, odd, empty):
    got = packing.pack_documents(odd, known_path("word_bpe_49k.json")).collect()
    want = Counter()
    for i, t, *_ in ODD:
        ids = np.append(ids_of("word_bpe_49k.json", t), 0).astype("<u4")
        for p in range(-(-len(ids) // 2048)):
            own = ids[2048 * p:2048 * (p + 1)]
            want[i, p, 2048 * p, len(own), zlib.crc32(own)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for slots in by.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(empty, known_path("word_bpe_49k.json")).count() == 0


def longest_fit(histogram, limit):
    left, n = dict(histogram), 0
    while left:
        room, config = limit, {}
        for size in sorted(left, reverse=True):
            if size <= room:
                config[size] = min(room // size, left[size])
                room -= size * config[size]
        times = min(left[k] // a for k, a in config.items())
        n += times
        left = {k: v - times * config.get(k, 0) for k, v in left.items() if v > times * config.get(k, 0)}
    return n


def test_plan_packs_no_worse_than_longest_fit():
    """On the lengths of sf0.1 and multiples of them, and all by configurations."""
    import pyarrow.parquet as pq
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist()
    encoder = Encoder(known_path("word_bpe_49k.json"))
    count = Counter()
    for t in texts:
        n = len(encoder._ids([t or ""])[0]) + 1
        count.update([2048] * (n // 2048) + ([n % 2048] if n % 2048 else []))
    for times in (1, 10, 100):
        histogram = {k: v * times for k, v in count.items()}
        plan = packing.pack_plan(histogram, 2048)
        placed = Counter()
        for sequences, config in plan:
            assert sequences > 0 and sum(k * a for k, a in config.items()) <= 2048
            for k, a in config.items():
                placed[k] += sequences * a
        assert placed == histogram
        used = sum(x for x, _ in plan)
        assert used <= longest_fit(histogram, 2048)
        assert used <= -(-sum(k * v for k, v in histogram.items()) // 2048) + 10 and len(plan) < 4000


@pytest.mark.parametrize("histogram, gap", [({700: 1000}, 0), ({1100: 100, 700: 10}, 1e-4), ({683: 999, 1025: 500, 400: 77}, 1e-4),
                                            ({k: 50 for k in range(600, 1500)}, 1e-4), ({k: 7 for k in range(1, 2048)}, 1e-4),
                                            (dict(zip(*np.unique(np.minimum(2047, np.exp(np.random.default_rng(3).normal(
                                                6, 1, 20_000)).astype(int) + 1), return_counts=True))), 2e-4)])
def test_configuration_program_is_solved_to_a_measured_gap(histogram, gap):
    size = np.array(sorted(histogram))
    demand = np.array([histogram[int(k)] for k in size])
    configs, value, bound = packing.configuration_lp(size, demand, 2048, np.random.default_rng(1))
    held = np.zeros(len(size))
    for x, js, a in configs:
        assert x > 0 and (size[js] * a).sum() <= 2048
        held[js] += x * a
    assert np.allclose(held, demand) and np.isclose(sum(x for x, _, _ in configs), value)
    assert bound <= value * (1 + 1e-12) and value <= bound * (1 + gap) + 1e-6 + (gap > 0)


def test_plan_where_sequences_cannot_be_filled():
    """The fullest sequence of a 1025 holds two 400s, but 683s have to go beside them."""
    histogram = {683: 999, 1025: 500, 400: 77}
    plan = packing.pack_plan(histogram, 2048)
    assert sum((Counter({k: x * a for k, a in c.items()}) for x, c in plan), Counter()) == histogram
    assert sum(x for x, _ in plan) == 750


@pytest.mark.parametrize("histogram, best", [({}, 0), ({5: 7}, 4), ({10: 1}, 1), ({6: 3, 4: 3}, 3), ({7: 2, 3: 1, 2: 2, 1: 1}, 3),
                                             ({9: 1, 1: 1, 5: 2}, 2), ({4: 5}, 3), ({1: 25}, 3)])
def test_plan_of_small_histograms(histogram, best):
    plan = packing.pack_plan(histogram, 10)
    assert sum(x for x, _ in plan) == best
    with pytest.raises(ValueError):
        packing.pack_plan({11: 1}, 10)


@pytest.mark.parametrize("base", [50_000, 60_000, 65_536, 70_000, 250_000])
def test_rules_for_every_vocabulary(base):
    rng = np.random.default_rng(4)
    phrase = rng.integers(0, base, 40)
    ids = np.concatenate([np.append(np.concatenate([rng.integers(0, base, 30), phrase]), 2) for _ in range(300)])
    ends = np.cumsum([71] * 300)
    row = token_files.compress(ids, ends, base)
    grammar, symbols, at = token_files.opened(row)
    assert len(grammar.rules) >= 20 and len(symbols) < 0.7 * len(ids)
    assert (grammar.expand(symbols) == ids).all()
    for i in (0, 7, 299):
        own = symbols[(at[i - 1] if i else 0):at[i]]
        assert (grammar.slice(own, 25, 60) == ids[71 * i:71 * (i + 1)][25:60]).all()


def test_random_access_prunes_blocks(spark, small, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_tokens(small, known_path("byte_bpe_50k.json"), path, block_ids=2000)
    wanted = small.orderBy("doc_id").select("doc_id", "text").collect()[57]
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = token_files.blocks_of(spark, path, wanted.doc_id)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(first_id" in plan and "GreaterThanOrEqual(last_id" in plan
    assert token_files.blocks_of(spark, path, wanted.doc_id).count() == 1
    ids = ids_of("byte_bpe_50k.json", wanted.text)
    assert token_files.read_document(spark, path, wanted.doc_id) == [[*ids.tolist(), 2]]


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(3)
    sizes = np.minimum(2048, np.exp(rng.normal(6, 1, 20_000)).astype(int) + 1)
    histogram = dict(zip(*(x.tolist() for x in np.unique(sizes, return_counts=True))))
    plan = packing.pack_plan(histogram, 2048)
    used = Counter()
    for times, config in plan:
        assert times > 0 and sum(k * a for k, a in config.items()) <= 2048
        for k, a in config.items():
            used[k] += times * a
    assert used == Counter(histogram)
    assert sum(t for t, _ in plan) <= 1.005 * -(-int(sizes.sum()) // 2048) + 1


def test_token_files_round_trip(spark, odd, empty, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_tokens(odd, known_path("byte_bpe_50k.json"), path, block_ids=500)
    got = token_files.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == 2
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4"))
        at += r.n_tokens
    assert [r.doc_id for r in got] == [r[0] for r in ordered(ODD)]
    want = Counter((i, *ids_of("byte_bpe_50k.json", t), 2) for i, t, *_ in ODD)
    assert Counter((r.doc_id, *r.ids) for r in got) == want
    whole = [*ids_of("byte_bpe_50k.json", LONG).tolist(), 2]
    assert token_files.read_document(spark, path, 5) == [whole]
    assert token_files.read_document(spark, path, 5, 1000, 1010) == [whole[1000:1010]]
    token_files.write_tokens(empty, known_path("byte_bpe_50k.json"), str(tmp_path / "none"))
    assert token_files.read_tokens(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(name):
    import pyarrow as pa
    rng = np.random.default_rng(1)
    parts = [*" \n\t'\".,-01aAbZzéÉßİΣς  日😀\x01\r\x0b\x85̸=", "'s", "'re", " the", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(3000)] + [None, ""]
    e = Encoder(known_path(name))
    ids, offs = e.encode(pa.array(texts))
    for i, want in enumerate(e._ids([t or "" for t in texts])):
        assert np.array_equal(ids[offs[i]:offs[i + 1]], want), texts[i]


def test_chat(spark):
    rows = [(1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 0, "user", "<|end|>\\<|turn|>"), (2, 0, None, None),
            (2, 0, "assistant", ""), (None, None, "assistant", "x" * 5000), (None, 3, "assistant", "[\\INST]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("clash"))
    made = chat.format_conversations(df, part_chars=1000)
    assert made.count() == 4                     # the null conversation is cut in two parts
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.format_conversations(df.filter("conv_id > 9"))).count() == 0


def test_template_language():
    t = chat.Template("{% set a = 'x' ~ 'y' %}{% if 1 == 2 %}no{% elif m %}{{ m['k'] | upper }}{% else %}-{% endif %}"
                      "{% for i in l %}{{ loop.index }}{{ a }}{% if not loop.last %},{% endif %}{% endfor %}")
    assert t.render(m={"k": "v"}, l=[1, 2])[0] == "V1xy,2xy"
    assert chat.Template("{% if true and 'a' == 'a' %}b{{ 'c' + 'd' }}{% endif %}").tree == [("text", "bcd")]
    for bad in ("{% for x in %}", "{{ a.b( }}", "{% if a %}", "{{ x | system }}", "{% endfor %}", "{{ 'a }}"):
        with pytest.raises(chat.TemplateError):
            chat.Template(bad)
    assert chat.Template("{{ m.__class__ }}").render(m={})[0] == ""


def test_fingerprints(spark, small, odd, empty):
    got = fingerprints.fingerprint_edits(small).collect()
    rows = sorted((r.doc_id, r.text or "") for r in small.collect())
    after = {d: rows[(k + 1) % len(rows)][1] for k, (d, _) in enumerate(rows)}
    near, real = [], []
    for r in got:
        text = dict(rows)[r.doc_id]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[r.doc_id][:cut]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = Counter(WORD.findall(text)), Counter(WORD.findall(edited))
        real.append(sum((a & b).values()) / max(1, sum((a | b).values())))
        near.append(r.near_edited)
    assert abs(np.mean(near) - np.mean(real)) < 0.02            # generalised Jaccard, on average
    out = fingerprints.fingerprint_edits(odd).collect()
    assert len(out) == len(ODD)
    by = defaultdict(set)
    for r in out:
        by[r.doc_id].add(r.fingerprint)
    assert by[5] == by[9] and by[2] == by[3] == by[4] and len(by[8]) == 1
    assert fingerprints.fingerprint_edits(empty).count() == 0


def brute_removed(docs):
    order = ordered(docs)
    seen, out = set(), []
    for i, t in order:
        w = WORD.findall(t or "")
        gone = set()
        for s in range(len(w) - 19):
            run = tuple(w[s:s + 20])
            if run in seen:
                gone.update(range(s, s + 20))
            seen.add(run)
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [256, 1])
def test_substring_dedup(spark, small, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_FRAGMENTS", hot)      # 1: every anchor takes the other road
    got = [tuple(r) for r in substring_dedup.removal_digest(small).collect()]
    assert sorted(got) == sorted(brute_removed([(r.doc_id, r.text) for r in small.collect()]))


def test_substring_dedup_on_odd_rows(spark, odd, empty):
    got = {(r.doc_id, r.n_words): r.n_removed for r in substring_dedup.removal_digest(odd).collect()}
    assert len(substring_dedup.removal_digest(odd).collect()) == len(ODD)
    assert got[6, 61] == 0 and got[7, 61] == 60 and got[None, 63] == 60 and got[9, 9000] == 9000 and got[2, 0] == 0
    assert got[5, 9000] == 9000 - 700 - 19 + 19                      # its own first round of 700 words stays
    cut = {(r.doc_id, r.text) for r in substring_dedup.without_repeats(odd).collect()}
    assert (7, "tail") in cut and 9 not in {d for d, _ in cut} and (4, " \n\t ") in cut and (2, None) in cut
    assert substring_dedup.without_repeats(odd).columns == odd.columns
    assert substring_dedup.without_repeats(empty).count() == 0


def test_matching_statistics():
    rng = np.random.default_rng(0)
    for _ in range(30):
        pieces = [rng.integers(0, 4, rng.integers(1, 30)).astype(np.uint64) for _ in range(4)]
        off = np.cumsum([0, *map(len, pieces)])
        order = [np.arange(len(p)) + o for p, o in zip(pieces, off)]
        index = FmIndex(pieces, order, 20)
        flat = np.concatenate(pieces)
        room = np.concatenate([np.arange(1, len(p) + 1) for p in pieces])
        got = index.matching_statistics(flat, np.arange(len(flat)), 20, np.concatenate(order), room)
        for e, n in enumerate(got):
            want = 0
            for size in range(1, min(20, room[e]) + 1):
                run = flat[e - size + 1:e + 1].tolist()
                if not any(p[i:i + size].tolist() == run and o[i] < e - size + 1
                           for p, o in zip(pieces, order) for i in range(len(p) - size + 1)):
                    break
                want = size
            assert n == want


def test_token_counts(spark, odd, empty):
    sizes = Counter(len(ids_of("byte_bpe_50k.json", t)) for _, t, *_ in ODD)
    got = {r.n_tokens: r for r in token_counts.token_counts(odd, known_path("byte_bpe_50k.json")).collect()}
    assert {k: r.n_docs for k, r in got.items()} == sizes
    for k, r in got.items():
        assert r.docs_longer == sum(n for s, n in sizes.items() if s > k)
        assert r.tokens_truncated == sum(min(s, k) * n for s, n in sizes.items())
        assert r.tokens_within == sum(s * n for s, n in sizes.items() if s <= k)
    assert token_counts.token_counts(empty, known_path("byte_bpe_50k.json")).count() == 0


def test_language_id(spark, odd, empty):
    docs = spark.read.parquet(SF_SMALL.replace("0.001", "0.01") + "/documents.parquet")
    model = lang_id.fit(docs.filter(~lang_id.held_out()))
    got = lang_id.predict(docs, model).withColumn("held", lang_id.held_out()).filter("held").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got) and all(0 <= r.score <= 1 for r in got)
    out = lang_id.predict(odd, model)
    assert Counter(r.lang_pred for r in out.collect() if r.doc_id in (2, 3, 4)) == {"und": 3}
    assert out.count() == len(ODD)
    assert lang_id.identified(odd).columns == odd.columns
    assert lang_id.identified(empty).count() == 0
    assert {r.lang_pred for r in lang_id.predict(odd, lang_id.Model()).collect()} == {"und"}


def test_language_sample_holds_different_texts(spark, monkeypatch):
    texts = [f"some words of text number {i}" for i in range(400)]
    low = spark.createDataFrame([(t,) for t in texts], "t string") \
        .orderBy(F.shiftrightunsigned(F.xxhash64(F.lit(5), "t"), 11)).first()["t"]      # first to be chosen
    rows = [(t, "en") for t in texts + [low] * 600] + [(f"mots du texte {i}", "fr") for i in range(300)]
    seen = []
    follow = lang_id._follow_leader

    def spy(train, n):
        seen.extend(train)
        return follow(train, n)

    monkeypatch.setattr(lang_id, "_follow_leader", spy)
    lang_id.fit(spark.createDataFrame(rows, "text string, lang string"), max_sample=100)
    assert Counter(y for _, _, y in seen) == {0: 40, 1: 40}
    assert len({(at.tobytes(), x.tobytes()) for at, x, _ in seen}) == 80


def test_labelled_documents_with_a_low_score_stay(spark):
    words = {"en": "the house and water", "fr": "une maison avec eau", "de": "das haus und wasser"}
    rows = [(i, f"{words[k]} {words[k]}", k, "a") for i, k in enumerate(list(words) * 40)]
    mixed = " ".join(words.values())
    held = spark.range(1000, 1100).filter(lang_id.held_out("id")).first()[0]     # not learned from
    model = lang_id.fit(spark.createDataFrame(rows, DOCS).filter(~lang_id.held_out()))
    best = lang_id.predict(spark.createDataFrame([(held, mixed, None, "a")], DOCS), model).first()
    assert best.score < 0.5
    for label, kept in ((best.lang_pred, 1), (None, 0)):
        docs = spark.createDataFrame([*rows, (held, mixed, label, "a")], DOCS)
        assert lang_id.identified(docs).filter(F.col("doc_id") == held).count() == kept


@pytest.mark.parametrize("template, once, want", [
    ("{% for m in messages %}{{ m.role }}.{% endfor %}", True, "system.user."),
    ("{% if messages[0].role == 'system' %}S:{% endif %}{% for m in messages %}{{ m.text }}{% endfor %}", False, "S:be shorthi"),
    ("{% for m in messages %}{{ m.role }}{% endfor %}|{% for m in messages %}{{ m.text }}{% endfor %}", False, "systemuser|be shorthi"),
    ("{{ messages | length }}{% for m in messages %}{{ m.role }}{% endfor %}", False, "2systemuser"),
    ("{% for m in messages %}{% for n in messages %}{{ n.role }}{% endfor %};{% endfor %}", False, "systemuser;systemuser;"),
    ("{% if true %}{% for m in messages %}{{ m.text }}{% endfor %}{% else %}{{ messages | length }}{% endif %}", True, "be shorthi"),
    ("{% set x = messages %}{% for m in x %}{{ m.role }}{% endfor %}{{ x | length }}", False, "systemuser2"),
])
def test_templates_may_use_messages_freely(spark, template, once, want):
    assert chat.reads_once(chat.fold(chat.parse(template)), "messages") is once
    rows = spark.createDataFrame([(1, 0, "system", "be short"), (1, 1, "user", "hi")], "conv_id long, turn long, role string, text string")
    assert [r.formatted for r in chat.format_conversations(rows, template).collect()] == [want]


def test_mixing(spark, small, odd, empty):
    for docs in (small, odd):
        got = mixing.mix_sizes(docs).collect()
        again = mixing.mix_sizes(docs.repartition(3)).collect()
        key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
        assert sorted(got, key=key) == sorted(again, key=key)
        assert all(0 <= r.taken <= 2 * r.size for r in got) and len(got) == docs.count()
        total = sum(r.size for r in got)
        targets = {(r.target, r.source_size) for r in got}
        assert all(t <= 2 * s + 1e-9 for t, s in targets) and sum(t for t, _ in targets) == pytest.approx(1.5 * total)
    copies = mixing.mixed_copies(odd)
    assert copies.columns == odd.columns and set(r["size"] for r in copies.collect()) <= {"clash"}
    assert mixing.mix_sizes(empty).count() == 0 and mixing.mixed_copies(empty).count() == 0


def test_mixing_cuts_repeated_rows_one_by_one(spark, tmp_path):
    import duckdb
    text = "one two three four"

    def early(i):                              # the draw of a row, as the operator makes it
        return hashlib.md5(f"0|{i}|{hashlib.md5(text.encode()).hexdigest()}".encode()).hexdigest()

    seven = min(range(100), key=early)
    rows = [(seven, text, "en", "b")] * 300 + [(i, "word " * (i % 9 + 1), "en", "abc"[i % 3]) for i in range(100, 500)]
    rows += [(seven, text, "fr", "b")] * 50 + [(3, None, "en", None), (None, "no id", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet') WHERE doc_id IS NOT NULL")
    got = mixing.mix_sizes(docs.filter("doc_id is not null"))
    found = con.sql(mixing.MIX_SQL)
    want = found.fetchall()
    assert Counter(str(tuple(r[c] for c in found.columns)) for r in got.collect()) == Counter(map(str, want))
    # the cut falls among them
    assert len(Counter(r.copies for r in got.filter(f"doc_id = {seven} and size = 4").collect())) == 2
    copies = [sorted(map(str, mixing.mixed_copies(docs.repartition(k)).collect())) for k in (1, 6)]
    assert copies[0] == copies[1]
    b = [r for r in mixing.mix(docs).filter("source = 'b'").collect()]
    assert abs(sum(r.taken for r in b) - b[0].target) <= 9


def test_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(8).tolist(), int(i % 2)) for i in range(60)]
    base = rng.standard_normal(8)
    rows += [(100 + i, (base + 0.12 * rng.standard_normal(8)).tolist(), 1) for i in range(90)]
    rows += [(300, None, 1), (301, [0.0] * 8, 1), (302, [float("nan")] + [1.0] * 7, 1), (303, [None] + [1.0] * 7, 1),
             (304, rows[0][1], None), (305, rows[1][1], 1), (305, rows[1][1], 1), (306, [1.0, 2.0], 1), (307, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("kept", F.lit("clash"))
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_dedup.near_vectors(df).collect())
    x = [np.array([np.nan if q is None else q for q in v], float) if v else None for _, v, _ in rows]
    ok = [a is not None and np.isfinite(a).all() and np.abs(a).max() > 0 and r[2] is not None for a, r in zip(x, rows)]
    link = [[i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j])
             and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.93 for j in range(len(rows))] for i in range(len(rows))]
    root = [r[0] for r in rows]
    for _ in range(len(rows)):
        root = [min([root[i], *(root[j] for j in range(len(rows)) if link[i][j])]) for i in range(len(rows))]
    assert got == sorted((r[0], sum(link[i]), root[i], r[0] == root[i]) for i, r in enumerate(rows))
    assert vector_dedup.near_vectors(df.filter("vec_id < 0")).count() == 0


@pytest.mark.parametrize("whole, n, mean", [(None, 6000, 0.85), (None, 3000, 0.7), (16, 1500, 0.85), (16, 1500, 0.0)])
def test_vectors_that_share_a_direction(spark, monkeypatch, whole, n, mean):
    if whole:                                          # so that passes alone settle most
        monkeypatch.setattr(vector_dedup, "WHOLE", whole)
        monkeypatch.setattr(vector_dedup, "WINDOW", 32)
    rng = np.random.default_rng(11)
    common = rng.standard_normal(64)
    common /= np.linalg.norm(common)
    x = rng.standard_normal((n, 64))
    x = mean ** 0.5 * common + (1 - mean) ** 0.5 * x / np.linalg.norm(x, axis=1)[:, None]
    for k in range(0, n // 10, 2):                     # planted pairs at about 0.935
        u = x[k] / np.linalg.norm(x[k])
        side = rng.standard_normal(64)
        side -= side @ u * u
        x[k + 1] = 0.935 * u + (1 - 0.935 ** 2) ** 0.5 * side / np.linalg.norm(side)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.93
    np.fill_diagonal(near, False)
    root = np.arange(n)
    while True:
        new = np.array([min(root[i], *root[near[i]]) if near[i].any() else root[i] for i in range(n)])
        if (new == root).all():
            break
        root = new
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_vectors(df).collect()}
    wrong = [i for i in range(n) if got[i] != (near[i].sum(), root[i])]
    assert near.sum() >= n // 10 and not wrong


def test_pipeline(spark, tmp_path, small):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
    per = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert per.filter("n > 2048 or n <> end").count() == 0 and out.count() > 100
    spark.createDataFrame([], small.schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_group_returns_links_not_pairs(spark):
    """Documents that resemble each other below the threshold make no rows; near
    ones at most one for each row of their tiles."""
    made = []
    for n in (60, 120):
        rng = np.random.default_rng(3)
        base = [f"w{i}" for i in range(400)]
        rows = []
        for i in range(n):
            words = list(base)
            for at in rng.choice(400, 9, replace=False):     # two of them: about 0.6 to 0.75
                words[at] = f"x{i}q{at}"
            rows.append((i, " ".join(words), "en", "a"))
        rows += [(1000 + i, " ".join([f"v{k}" for k in range(400)] + [f"tail{i}"]), "en", "a") for i in range(n)]
        docs = spark.createDataFrame(rows, DOCS)
        kept = {}
        link = minhash._joined_in_buckets

        def spy(*args):
            out = link(*args)
            kept["rows"] = (args[0].count(), out.count())
            return out

        with pytest.MonkeyPatch.context() as m:
            m.setattr(minhash, "_joined_in_buckets", spy)
            got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
        sets = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, w in ((r[0], r[1].split()) for r in rows)}
        root = {i: i for i in sets}
        for i, j in ((i, j) for i in sets for j in sets if i < j):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                a, b = sorted((root[i], root[j]))
                root = {k: a if v == b else v for k, v in root.items()}
        assert got == root
        made.append(kept["rows"])
    assert all(out <= placed for placed, out in made)


def test_one_of_each_takes_the_first_row(spark):
    rows = [(1, "x y z", "fr", "b"), (1, "x y z", "en", "c"), (1, "x y z", "en", None), (2, "other words", "en", "a"), (2, "more", "de", "a")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("_lk_h", F.lit("clash"))
    seen = {tuple(sorted(str(tuple(r)) for r in minhash.one_of_each(docs.repartition(k, "lang", "source")).collect())) for k in (1, 2, 5)}
    assert len(seen) == 1 and len(next(iter(seen))) == 3 and minhash.one_of_each(docs).columns == docs.columns
