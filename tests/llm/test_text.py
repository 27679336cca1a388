import random
import unicodedata
from collections import Counter

import pytest

from marketloom.llm import encode, packing, visual

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def encoder():
    with open(encode.VOCABULARY, "rb") as f:
        return encode.Encoder(encode.read_ranks(f.read()))


@pytest.fixture(scope="module")
def peer():
    t = tokenizers.Tokenizer.from_file(encode.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


TEXTS = ["", " ", "Hello, world's 1234", "<|endoftext|> x", "a" * 5000, "ab" * 3000, "=-" * 2000, "終値は" * 500, "\n" * 3000, " " * 3001 + "x", "é" * 999, "👩‍💼🚀", "́​﻿", "नेट क्‍लोज़िंग"]


def test_tokens_equal_the_library(encoder, peer):
    r = random.Random(2)
    words = ["".join(r.choice("abcdefinorst") for _ in range(r.randint(30, 700))) for _ in range(60)]
    for t in TEXTS + words:
        assert encoder.encode(t) == peer(t), t[:30]


def test_stream_emits_before_the_end_and_forgets(encoder, peer):
    fed = []

    def pieces():
        for _ in range(300):
            fed.append(1)
            yield b"deconstruction" * 3

    out = encoder.stream(pieces())
    first = next(out)
    assert len(fed) < 30
    assert [first, *out] == peer("deconstruction" * 900)


def test_every_word_runs_through_the_transducer(encoder, peer, monkeypatch):
    fresh = encode.Encoder(encoder.ranks)
    seen = []
    real = fresh.stream
    monkeypatch.setattr(fresh, "stream", lambda chunks: real(seen.append(c) or c for c in chunks))
    text = "On a day, 12 words! " + "終値は" * 900
    assert fresh.encode(text) == peer(text)
    assert b"".join(seen) == text.encode()
    assert max(map(len, seen)) <= 3 * encode.PIECE


def vocabulary(r, letters, size, longest):
    ranks = {bytes([c]): i for i, c in enumerate(letters)}
    for _ in range(4 * size):
        t = r.choice(list(ranks)) + r.choice(list(ranks))
        if len(t) <= longest and t not in ranks and len(ranks) < size:
            ranks[t] = len(ranks)
    return ranks


def test_lookahead_of_the_merge_list_is_sufficient(monkeypatch):
    """On random merge lists the tokens emitted early are those of the whole text, and the state keeps its bound."""
    monkeypatch.setattr(encode, "STEP", 1)
    r = random.Random(9)
    early = 0
    for _ in range(60):
        e = encode.Encoder(vocabulary(r, b"abc", r.randint(4, 40), r.randint(2, 8)))
        for _ in range(20):
            text = bytes(r.choice(b"abc") for _ in range(r.randint(1, 200)))
            want = e.merge(text)
            assert list(e.stream(bytes([c]) for c in text)) == want
            # what has the lookahead behind it doesn't change with the text that follows
            cut = r.randint(0, len(text))
            head, at = e.merge(text[:cut]) if cut else [], 0
            for x, y in zip(head, want):
                at += len(e.tokens[x])
                if at + e.lookahead > cut:
                    break
                assert x == y
                early += 1
        assert e.most_held <= e.lookahead + e.longest + 1
    assert early > 500


def test_state_is_bounded_however_long_the_word(encoder):
    e = encode.Encoder(encoder.ranks)
    sizes = []
    for n in (2_000, 60_000):
        for word in ("a" * n, "=-" * n, "".join(random.Random(n).choice("abcdeinorst") for _ in range(n))):
            assert sum(len(e.tokens[t]) for t in e.stream([word.encode()])) == len(word)
        sizes.append(e.most_held)
    assert sizes[0] == sizes[1] <= e.lookahead + e.longest + encode.STEP
    assert e.lookahead == 178


def test_decoder_round_trip(encoder):
    d = encode.Decoder(encoder.ranks)
    for t in TEXTS:
        assert "".join(d.feed([i]) for i in encoder.encode(t)) + d.end() == t


def test_encode_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "Hi Hi", "x"), (3, "Hi Hi", "x")], "doc_id long, text string, ids string")
    got = sorted((r["doc_id"], list(r["ids"])) for r in encode.encode(df, "doc_id", "text").collect())
    assert got == [(1, []), (2, []), (3, [17250, 15902]), (3, [17250, 15902])]
    assert encode.encode(df.limit(0), "doc_id", "text").collect() == []
    assert all(r["same"] for r in encode.round_trip(df, "doc_id", "text").collect())


def check_packing(rows, sizes, capacity):
    spans, bins = {}, {}
    for r in rows:
        spans.setdefault(r["doc_id"], []).append((r["token_start"], r["token_end"]))
        bins.setdefault(r["container"], []).append(r)
    assert sorted(spans) == sorted(sizes)
    for d, s in spans.items():
        s.sort()
        assert s[0][0] == 0 and s[-1][1] == sizes[d] and all(a[1] == b[0] for a, b in zip(s, s[1:]))
        assert len(s) == max(1, -(-sizes[d] // capacity))
    for rs in bins.values():
        rs.sort(key=lambda r: r["position"])
        assert [r["position"] for r in rs] == list(range(len(rs)))
        at = 0
        for r in rs:
            n = r["token_end"] - r["token_start"]
            assert n == 0 or r["container_start"] == at
            at += n
        assert at <= capacity
    return len(bins)


def test_packing_is_whole_and_tight(spark):
    r = random.Random(4)
    sizes = {i: r.choice([0, 1, 7, 33, 64, 65, 100, 64 * 3, r.randrange(1, 64)]) for i in range(3000)}
    sizes |= {5000 + i: 20 for i in range(3000)}  # one frequent size
    df = spark.createDataFrame([(k, None if v == 0 and k % 2 else v, "x") for k, v in sizes.items()], "doc_id long, n long, container string")
    used = check_packing(packing.pack(df, "doc_id", "n", 64).collect(), sizes, 64)
    assert used <= 1.05 * sum(sizes.values()) / 64 + 1
    empty = df.limit(0)
    assert packing.pack(empty, "doc_id", "n", 64).collect() == []
    zero = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, n long")
    check_packing(packing.pack(zero, "doc_id", "n", 64).collect(), {1: 0, 2: 0}, 64)


def test_layout_places_every_item_once():
    r = random.Random(6)
    for _ in range(50):
        cap = r.choice([10, 64, 97])
        sizes = Counter(r.randrange(1, cap + 1) for _ in range(r.randrange(0, 400)))
        lay = packing.Layout(sizes, cap)
        assert Counter({s: sum(x[2] for x in lay.runs if x[0] == s) for s in sizes}) == sizes
        load = Counter()
        for s, _, n, c, _, _ in lay.runs:
            for k in range(n):
                load[c + k] += s
        assert all(v <= cap for v in load.values())


SAME = [("ＡＢＣ　１２", "ABC 12"), ("café", "café"), ("caf​é", "café"), ("pаypal", "paypal"), ("no break", "no break"), ("soft­hyphen", "softhyphen"), ("ё", "ë"), ("ⅼⅰne", "line"), ("Ⅻ ﬁ", "XII fi"), ("a\r\nb", "a\nb")]
APART = [("m²", "m2"), ("½", "1/2"), ("facade", "façade"), ("Case", "case"), ("up on", "upon"), ("1.5", "1,5"), ("a  b", "a b")]


def test_forms(spark):
    pairs = SAME + APART
    df = spark.createDataFrame([(2 * i + j, t) for i, p in enumerate(pairs) for j, t in enumerate(p)], "doc_id long, text string")
    form = {r["doc_id"]: r["form"] for r in visual.consistent(df, "doc_id", "text").collect()}
    for i, p in enumerate(pairs):
        assert (form[2 * i] == form[2 * i + 1]) == (p in SAME), p
    again = spark.createDataFrame(list(form.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["form"] for r in visual.consistent(again, "doc_id", "text").collect()} == form
    assert all(unicodedata.is_normalized("NFC", f) for f in form.values())


def test_canonically_equal_texts_have_one_form(spark):
    found = [chr(c) for c in [*range(0x370, 0x530), *range(0x1F00, 0x2000)] if len(unicodedata.normalize("NFD", chr(c))) > 1]
    texts = [f(c) for c in found for f in (str, lambda c: unicodedata.normalize("NFD", c), lambda c: unicodedata.normalize("NFC", c))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    form = {r["doc_id"]: r["form"] for r in visual.consistent(df, "doc_id", "text").collect()}
    assert [c for i, c in enumerate(found) if len({form[3 * i + k] for k in range(3)}) > 1] == []
    assert form[3 * found.index("\u0389")] == "H\u0301" and form[3 * found.index("\u045e")] == "y\u0306"
    again = spark.createDataFrame(list(form.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["form"] for r in visual.consistent(again, "doc_id", "text").collect()} == form


def test_pairs(spark):
    rows = [(1, "ab c"), (2, "ab c"), (3, "ab c"), (4, None), (5, ""), (6, " ​"), (7, "　"), (8, "x" * 200_000), (9, "x" * 199_999 + "х"), (10, "ab  c"), (11, "lonely"), (12, "lonely")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, form string")
    assert sorted(tuple(r) for r in visual.look_alike_pairs(df, "doc_id", "text").collect()) == [(1, 2), (2, 3), (8, 9)]
    assert visual.look_alike_pairs(df.limit(0), "doc_id", "text").collect() == []


def test_pairs_and_classes_of_hot_spellings(spark):
    rows = [(i, "f", "s" if i % 3 else "t") for i in range(90)] + [(200, "g", "u"), (201, "g", "u"), (300, "h", "v")]
    df = spark.createDataFrame(rows, "id long, form string, spelling string")
    got = sorted(tuple(r) for r in visual.pairs_of(df, "doc_id", salts=3).collect())
    assert got == sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and a[2] != b[2])
    docs = spark.createDataFrame([(3, "ab"), (1, "аb"), (2, "ab"), (4, None), (5, " "), (6, "x"), (7, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in visual.classes(docs, "doc_id", "text").collect()) == [(1, 1, 1), (2, 1, 2), (3, 1, 2), (6, 6, 6)]
    assert visual.classes(docs.limit(0), "doc_id", "text").collect() == []


def test_letters_of_the_same_shape_and_those_that_only_resemble(spark):
    same = [("ꓮꓐꓚ", "ABC"), ("ⲞⲢ", "OP"), ("a⠀b", "a b")]
    apart = [("ɑɡᴏ", "ago"), ("𝐚𝑏", "ab"), ("αγικυ", "ayiku"), ("кг", "kr"), ("²", "2")]
    df = spark.createDataFrame([(2 * i + j, t) for i, p in enumerate(same + apart) for j, t in enumerate(p)], "doc_id long, text string")
    form = {r["doc_id"]: r["form"] for r in visual.consistent(df, "doc_id", "text").collect()}
    assert [form[2 * i] == form[2 * i + 1] for i in range(len(same + apart))] == [True] * len(same) + [False] * len(apart)
