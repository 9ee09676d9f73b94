import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from fixtures import TEXTS, documents, none, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewlib.llm import (
    histogram_shards,
    language_id,
    licenses,
    outliers,
    pieces,
    quality,
    secret_automata,
    token_files,
)
from reviewlib.llm.words import Coder

# -- token files -----------------------------------------------------------------------

JSON = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
ODD = ["", "a  b", " x  y\n z", "<|endoftext|> hi<|endoftext|>there ", "　 a　b  \n\n c", "it's we'LL 'tis",
       "\t a \r\n b", "é 中文 😀 x", "a\x1cb \x1c c", "a  b   c​ d", "a\x85 b à, ç! (x) 12,5 %%%"]


def test_ids_are_the_librarys():
    tok, texts = Tokenizer.from_str(JSON), ODD + [t for _, t in TEXTS] + ODD
    ids, bounds = token_files.Ids(JSON, 2)(pa.array(texts))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == tok.encode(text or "", add_special_tokens=False).ids + [2]


SPACES = "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def test_ids_beside_white_space_past_ascii():
    tok, draw = Tokenizer.from_str(JSON), np.random.default_rng(3)
    marks = [*"\n\n  \t.!'é中", "foo", "bar", "'s", *SPACES, *"\xa0\xa0\xa0\u200b\u180e"]
    texts = [f"foo{a}{s}{b}bar" for s in SPACES for a in ("\n", " ", "") for b in ("\n", " ", "\n ", "")]
    texts += ["".join(draw.choice(marks, 8)) for _ in range(5_000)]
    ids, bounds = token_files.Ids(JSON, 2)(pa.array(texts))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == tok.encode(text, add_special_tokens=False).ids + [2], ascii(text)


def test_the_next_task_of_a_worker_encodes_only_new_pieces(monkeypatch):
    tok, texts = Tokenizer.from_str(JSON), ODD + [t for _, t in TEXTS]
    token_files._ids(JSON, 2)(pa.array(texts))
    sent, encode = [], token_files.Ids._encode
    monkeypatch.setattr(token_files.Ids, "_encode", lambda self, x: sent.extend(x) or encode(self, x))
    ids, bounds = token_files._ids(JSON, 2)(pa.array([*texts[::-1], "brandnewword"]))
    assert sent == ["brandnewword\n"]
    for text, a, b in zip([*texts[::-1], "brandnewword"], bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == tok.encode(text or "", add_special_tokens=False).ids + [2]


def test_forgotten_pieces_are_encoded_again(monkeypatch):
    monkeypatch.setattr(token_files, "_CACHE", 10)
    tok, encode = Tokenizer.from_str(JSON), token_files.Ids(JSON, 2)
    for _, text in TEXTS * 2:
        ids, _ = encode(pa.array([text]))
        assert ids.tolist() == tok.encode(text or "", add_special_tokens=False).ids + [2]
        assert len(encode.row) == len(encode.known) and (np.diff(encode.known.astype(float)) >= 0).all()


def test_ids_of_a_tokenizer_with_other_rules():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        rules = file.read()
    tok = Tokenizer.from_str(rules)
    ids, bounds = token_files.Ids(rules, 9)(pa.array(ODD))
    for text, a, b in zip(ODD, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == tok.encode(text, add_special_tokens=False).ids + [9]


@pytest.mark.parametrize("counts", [[1], [5, 1], [1, 1, 1], [2**k for k in range(40)], list(range(1, 999))])
def test_code_lengths_are_best_within_the_limit(counts):
    import heapq

    counts = np.array(counts)
    lengths = token_files.code_lengths(counts)
    assert lengths.max() <= token_files.MAX_BITS and (2.0**-lengths).sum() <= 1
    heap, total = sorted(counts.tolist()), 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    best = total or int(counts.sum())
    assert (lengths * counts).sum() >= best
    if len(counts) < token_files.MAX_BITS:
        assert (lengths * counts).sum() == best
    book = token_files.Book(np.arange(len(counts)) * 3, lengths)
    ids = np.random.default_rng(0).integers(0, len(counts), 3_000) * 3
    data, at = book.encode(ids)
    sizes = np.full(-(-len(ids) // 256), 256)
    sizes[-1] = len(ids) - 256 * (len(sizes) - 1)
    assert (book.decode(data, at[:-1:256], sizes) == ids).all()


def test_token_files_round_trip(spark, tmp_path):
    tok = Tokenizer.from_str(JSON)
    token_files.write(documents(spark), str(tmp_path / "f"), JSON, 2)
    got = token_files.read(spark, str(tmp_path / "f")).orderBy("start").collect()
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in order]
    want = [tok.encode(t or "", add_special_tokens=False).ids + [2] for _, t in order]
    assert [r.ids for r in got] == want
    assert [r.start for r in got] == np.cumsum([0, *map(len, want)])[:-1].tolist()
    packed = token_files.read(spark, str(tmp_path / "f"), packed=True)
    crc = {(r.doc_id, r.start): r.c for r in packed.select("*", F.crc32("ids").alias("c")).collect()}
    assert crc == {(r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}


def test_token_files_of_nothing(spark, tmp_path):
    token_files.write(none(spark), str(tmp_path / "f"), JSON, 2)
    assert token_files.read(spark, str(tmp_path / "f")).collect() == []


# -- pieces ----------------------------------------------------------------------------

MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


def test_pieces_are_the_librarys_and_spans_give_the_text(spark):
    sp = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    texts = TEXTS + [(100 + i, t) for i, t in enumerate(ODD)]
    for r in pieces.encode(documents(spark, texts), MODEL).collect():
        text = r.text or ""
        assert r.ids == sp.encode(text) and r.decoded == sp.decode(r.ids)
        data = text.encode()
        assert len(r.starts) == len(r.ends) == len(r.ids)
        if r.ids:
            assert r.starts[0] == 0 and r.ends[-1] == len(data)
            assert all(a <= b for a, b in zip(r.starts, r.ends))
            assert all(b == a for a, b in zip(r.starts[1:], r.ends))
        for i, a, b in zip(r.ids, r.starts, r.ends):
            if not sp.is_byte(i):
                assert data[a:b].decode() == sp.id_to_piece(i).replace("▁", " ")[-len(data[a:b].decode()):] or a == b
    assert pieces.encode(none(spark), MODEL).collect() == []


class Spec:
    add_dummy_prefix, remove_extra_whitespaces, escape_whitespaces = True, True, True

    def __init__(self, compiled):
        self.precompiled_charsmap = compiled


def compiled_map(rules: dict[bytes, bytes]) -> bytes:
    """A double array of ``rules``, built node by node with bases that do not overlap."""
    texts, starts = b"", {}
    for key, new in rules.items():
        starts[key] = len(texts)
        texts += new + b"\0"
    units, nodes = {0: 0}, [(0, b"")]
    base = 256
    while nodes:
        at, prefix = nodes.pop()
        below = {k[len(prefix)] for k in rules if k.startswith(prefix) and len(k) > len(prefix)}
        if not below and prefix not in rules:
            continue
        offset = at ^ base
        assert offset < 1 << 21
        units[at] = units.get(at, 0) | offset << 10 | (1 << 8 if prefix in rules else 0)
        if prefix in rules:
            units[base] = 1 << 31 | starts[prefix]
        for b in below:
            units[base ^ b] = b
            nodes.append((base ^ b, prefix + bytes([b])))
        base += 256
    array = np.zeros(base + 256, "<u4")
    for k, v in units.items():
        array[k] = v
    raw = array.tobytes()
    return len(raw).to_bytes(4, "little") + raw + texts


def test_longest_prefix_normalisation():
    rules = {"a".encode(): b"1", "ab".encode(): b"22", "é".encode(): b"e", "\t".encode(): b" ", "x".encode(): b""}
    normal = pieces.Normalizer(Spec(compiled_map(rules)))
    text, places = normal("  abaé\t\t xz ".encode())
    assert text.decode() == "▁221e▁z"
    assert places.tolist() == [2, 2, 2, 2, 2, 4, 5, 7, 7, 7, 11, 13]
    assert normal(b"  ")[0] == b"" and normal(b"")[0] == b""


# -- secrets ---------------------------------------------------------------------------


def labelled(n=40):
    draw = np.random.default_rng(1)
    hexes = ["".join(draw.choice(list("0123456789abcdef"), 40)) for _ in range(n)]
    keys = ["AKIA" + "".join(draw.choice(list("ABCDEFGHJKLMNPQRSTUVWXYZ23456789"), 16)) for _ in range(n)]
    return [
        (i, f'{prose(i, 30)} Token: "{h}" {prose(i + 500, 30)} {k} API_KEY={h[:12]} secret: short')
        for i, (h, k) in enumerate(zip(hexes, keys))
    ]


def test_base_spans():
    text = 'é password = "abcd1234" token: secret: abcdefghij passwd:1234567 AKIA0123456789AB ' + "0" * 31 + " " + "f" * 32
    found = [(text[a:b], kind) for a, b, kind, _ in secret_automata.base_spans(text)]
    assert found == [('password = "abcd1234', "assign"), ("AKIA0123456789AB", "access"), ("f" * 32, "hex")]
    assert secret_automata.base_spans("") == []
    assert [s[2] for s in secret_automata.base_spans("token=" + "a" * 40)] == ["assign", "hex"]


def test_learned_formats(spark):
    ordinary = prose(3, 500) + " " + prose(4, 500).upper() + " " + " ".join(map(str, range(10**9, 10**9 + 400)))
    docs = documents(spark, labelled() + [(900, ordinary), (901, None), (902, "")])
    formats = secret_automata.learn(docs)
    assert set(formats.automata) == {"assign", "access", "hex"}
    draw = np.random.default_rng(2)
    fresh = "".join(draw.choice(list("0123456789abcdef"), 30))  # too short for the fixed pattern
    rows = [(1, f"see {fresh} there"), (2, prose(8, 300)), (3, "THISISAVERYLONGWORDINDEED 1234567890123456"), (4, None)]
    got = {r.doc_id: r.secrets for r in secret_automata.find(documents(spark, rows), formats).collect()}
    assert [(s.kind, s.start, s.end) for s in got[1]] == [("format", 4, 34)]
    assert got[2] == [] and got[3] == [] and got[4] == []
    clean = {r.doc_id: r.text for r in secret_automata.redact(documents(spark, rows + labelled()[:1]), formats).collect()}
    assert clean[1] == "see [secret] there" and clean[4] is None
    assert clean[0].count("[secret]") == 3 and "secret: short" in clean[0]


def test_nothing_to_learn_from(spark):
    formats = secret_automata.learn(none(spark))
    assert formats.automata == {} and formats.spans("x" * 50) == []


def test_merging_keeps_formats_apart():
    strings = [[0] * 12] * 200 + [[3] * 4 + [2] * 8] * 200
    automaton = secret_automata.Inference(secret_automata.prefix_tree(strings)).automaton()
    own = [automaton.likelihood([0] * 12), automaton.likelihood([3] * 4 + [2] * 8)]
    assert min(own) > automaton.likelihood([0] * 6 + [2] * 6) + 5


# -- shards ----------------------------------------------------------------------------


def test_shards(spark):
    texts = [(i, prose(i, 1 + i % 90)) for i in range(3_000)] + TEXTS
    out = histogram_shards.shard(documents(spark, texts), n_shards=6).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in texts)
    by_id = dict(texts[:3_000])
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r["size"]
        if r.doc_id in by_id and r.doc_id >= 20:
            data = by_id[r.doc_id].encode()
            assert (r["size"], r.text_crc32) == (len(data) + 8, zlib.crc32(data))
    slots = {s: sorted(r.slot for r in out if r.shard == s) for s in sizes}
    assert all(v == list(range(len(v))) for v in slots.values()) and set(slots) == set(range(6))
    largest = max(r["size"] for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * (largest + sum(sizes.values()) / 6 * 0.002)
    assert histogram_shards.shard(none(spark)).collect() == []


def test_shards_of_repeated_and_null_rows(spark):
    for texts in ([(7, "same text " * 20)] * 2_000 + [(i, prose(i, 1 + i % 40)) for i in range(1_000)],
                  [(None, None)] * 3_000):
        out = histogram_shards.shard(documents(spark, texts).repartition(4), n_shards=6).collect()
        sizes = Counter()
        for r in out:
            sizes[r.shard] += r["size"]
        largest = max(r["size"] for r in out)
        assert len(out) == len(texts) and set(sizes) == set(range(6))
        assert max(sizes.values()) - min(sizes.values()) <= 2 * (largest + sum(sizes.values()) / 6 * 0.002)


# -- quality rules ---------------------------------------------------------------------


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rules_count_as_stated(spark):
    texts = TEXTS + [(50, "a\nb\na\n \n \nb c\na"), (51, "#*$%&|<> a b"), (52, "x y z v w q x y z v w " * 3)]
    out = outliers.judge(documents(spark, texts)).collect()
    want = Counter((i, *counted(t)) for i, t in texts)
    fields = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter(tuple(r[f] for f in fields) for r in out) == want
    for r in out:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert outliers.judge(none(spark)).collect() == []


def test_outliers_of_a_group_are_not_kept(spark):
    texts = [(i, prose(i, 100 + i % 50)) for i in range(1, 200) if i % 5 and i % 7]
    odd = [(1_003, " ".join(f"{w}***" for w in prose(7, 80).split(" "))), (1_002, "abcdefghijklmnopqrst " * 3 + " ".join(f"{k}bcdefghijklmnopqrs" for k in range(60)))]
    kept = {r.doc_id: r.kept for r in outliers.judge(documents(spark, texts + odd)).collect()}
    assert not kept[1_003] and not kept[1_002]
    assert all(kept[i] for i, _ in texts)


def test_a_small_language_is_judged_in_the_pool_of_all(spark):
    rows = [(i, prose(i, 60 + i % 40), "en" if i < 300 else "xx", "s") for i in range(1, 341)]
    rows += [(1_000, " ".join(f"{w}####" for w in prose(3, 30).split(" ")), "xx", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in outliers.judge(docs).collect()}
    assert all(r.distance is not None for r in got.values() if not r.base_failed)
    assert not got[1_000].kept and got[1_000].distance is not None
    assert sum(r.kept for r in got.values()) >= 330


# -- languages and quality -------------------------------------------------------------

LANGS = {"aa": "kala mino teru sopa neli", "bb": "strok vrumt dralk gnist plok"}


def speech(lang, seed, n=40):
    draw = np.random.default_rng(seed)
    return " ".join(draw.choice(LANGS[lang].split(" ")) + draw.choice(["", "a", "u"]) for _ in range(n))


def test_languages(spark):
    rows = [(i, speech(k, i), k, "s") for i, k in enumerate(["aa", "bb"] * 30)] + [(99, None, "aa", "s"), (98, "x", None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language_id.fit(docs)
    assert model.languages == ["aa", "bb"]
    tried = [(1, speech("aa", 500)), (2, speech("bb", 501).upper()), (3, "kalamino, TERUSOPA!"), (4, None), (5, "12 -- 3"), (6, "")]
    out = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(documents(spark, tried), model).collect()}
    assert [out[i][0] for i in range(1, 7)] == ["aa", "bb", "aa", "und", "und", "und"]
    assert all(0 <= s <= 1 for _, s in out.values()) and out[4][1] == 0
    nothing = language_id.fit(docs.filter("false"))
    assert {r.lang_pred for r in language_id.predict(documents(spark, tried), nothing).collect()} == {"und"}
    assert language_id.predict(none(spark), model).collect() == []


def test_a_small_language_is_not_pushed_out(spark):
    letters = "abcdefghijklmnop"
    many = ["".join(letters[n >> k & 15] for k in (0, 4, 8, 12, 16)) for n in range(210_000)]
    texts = [" ".join(many[i::30]) for i in range(30)]
    rows = [(i, texts[i % 30], "aa") for i in range(60)] + [(90, "zuwy wuzy tryz", "zz")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "zz"] and len(model.codes) == 210_003
    tried = [(1, "zuwy tryz"), (2, "wuzys"), (3, many[7] + " " + many[-1])]
    out = language_id.predict(documents(spark, tried), model).collect()
    assert {r.doc_id: r.lang_pred for r in out} == {1: "zz", 2: "zz", 3: "aa"}


def test_backing_off_takes_the_longest_known_grams():
    grams = np.log(np.array([[0.9, 0.1], [0.2, 0.8]]))
    model = language_id.Model(["x", "y"], np.zeros(1, np.uint64), np.zeros((1, 2), np.float32), {"abc": 0, "a": 1}, grams)
    scorer = language_id.Scorer(model)
    assert (scorer.back_off("abc") == grams[0]).all() and (scorer.back_off("za") == grams[1]).all()
    assert (scorer.back_off("qq") == 0).all()


def test_quality(spark):
    good = [(i, prose(i, 20 + i % 60)) for i in range(1, 160)]
    bad = [(i, " ".join(f"{w}###" for w in prose(i, 20 + i % 60).upper().split(" "))) for i in range(200, 300)]
    docs = documents(spark, good + bad + TEXTS[:3])
    labels = spark.createDataFrame(
        [(i, 1) for i, _ in good[:120]] + [(i, 0) for i, _ in bad[:70]] + [(1, 1), (None, 0), (7, None)],
        "doc_id long, quality int",
    )
    model = quality.fit(docs, labels)
    out = {r.doc_id: r.s for r in quality.score(docs, model, out="s").collect()}
    assert all(out[i] > 0.5 for i, _ in good[120:]) and all(out[i] < 0.5 for i, _ in bad[70:])
    assert all(0 <= s <= 1 for s in out.values())
    empty = quality.fit(none(spark), labels)
    assert all(0 <= r.s <= 1 for r in quality.score(docs, empty, out="s").collect())
    assert quality.score(none(spark), model, out="s").collect() == []


def test_quality_learns_from_every_labelled_document(spark, monkeypatch):
    """Every labelled text counts, however many there are, and shards trained apart agree."""
    own = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(8_400)]
    rows = [(i, f"{w} good fine" if i % 3 else f"{w} ### ###") for i, w in enumerate(own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 3 > 0) quality").unionByName(
        spark.createDataFrame([(3, 0), (5, 1), (5, 1)], "doc_id long, quality int")
    )
    monkeypatch.setattr(quality, "ROUND", 20)
    monkeypatch.setattr(quality, "SHARD", 2_000)
    model = quality.fit(docs, labels)
    group = next(Coder(lower=False, split=True).groups(pa.array([" ".join(own)])))
    assert np.isin(group.codes, model.codes).all()
    out = {r.doc_id: r.s for r in quality.score(docs, model, out="s").collect()}
    assert all((s > 0.5) == (i % 3 > 0) for i, s in out.items())


def test_quality_shards_hold_every_row_once(spark, monkeypatch):
    monkeypatch.setattr(quality, "SHARD", 7)
    rows = [(i % 40, i % 2, [float(i + k) for k in range(quality.SIZE + 2)]) for i in range(60)]
    shards = quality._shards(spark.createDataFrame(rows, "doc_id long, y int, x array<double>"))
    assert shards.count() > 4
    got = quality._added(shards, 3, lambda x, y, held: np.array([len(x), y.sum(), x[:, 0].sum()]))
    assert got.tolist() == [60, 30, sum(range(60))]
    mean, spread = quality._scales(shards)
    x = np.array([r[2] for r in rows])[:, : quality.SIZE + 1]
    assert np.allclose(mean, x.mean(0)) and np.allclose(spread, x.std(0) + 1e-3)


def test_quality_training_carried_on_is_training_in_one_go():
    draw = np.random.default_rng(5)
    x, y = draw.normal(size=(300, quality.SIZE + 2)), draw.integers(0, 2, 300).astype(float)
    like = quality._start(quality.SIZE + 2)
    state = quality._flat([*like, *(np.zeros_like(p) for p in like + like)])
    parts = state
    for begin, end in ((0, 5), (5, 7), (7, 12)):
        parts = quality._epochs(parts, x, y, begin, end)
    assert np.array_equal(parts, quality._epochs(state, x, y, 0, 12)) and not np.array_equal(parts, state)


# -- licences --------------------------------------------------------------------------


def test_licences(spark):
    mit = dict(licenses.KNOWN[0:1])["MIT"]
    odd = "Copyright (c) 2020 Somebody\n\n" + mit.lower().replace(", ", " -- ").replace("software is", "software\nis")
    texts = [
        (1, mit), (2, odd), (3, mit + " more"), (4, None), (5, ""), (6, "prose\nReleased under the MIT licence.\nmore"),
        (7, "© 2001 X\n(c) Y\n"), (8, "Copyright owners agree.\nReleased under the MIT License"),
    ]
    out = {r.doc_id: r for r in licenses.scan(documents(spark, texts), licenses.known_digests(spark)).collect()}
    assert out[1].license == "MIT" and out[2].license == "MIT" and out[2].digest == out[1].digest
    assert [out[i].license for i in (3, 4, 5, 7)] == [None] * 4
    nothing = hashlib.sha256(b"").hexdigest()
    assert out[4].digest == out[5].digest == out[7].digest == nothing
    assert out[6].notices == "MIT" and out[6].license is None and out[8].license == "MIT"
    assert licenses.scan(none(spark), licenses.known_digests(spark)).collect() == []


def test_every_whole_licence_file_is_found(spark):
    files = {p.stem: p.read_text(encoding="utf-8") for p in licenses._FILES.glob("*.txt")}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0", "Unlicense", "Zlib", "BSL-1.0"} <= set(files)
    texts, names = [], {}
    for name, body in files.items():
        odd = "Copyright (c) 2020 Somebody\n\n" + body.upper().replace(", ", " -- ").replace("\n", "\r\n")
        filled = body.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2021 Somebody Else")
        for text, want in ((body, name), (odd, name), (filled, name), (body + "\nand more", None), (body[:-200], None)):
            texts.append((len(texts), text))
            names[texts[-1][0]] = want
    found = licenses.scan(documents(spark, texts), licenses.known_digests(spark)).collect()
    assert {r.doc_id: r.license for r in found} == names


def test_known_licences_differ(spark):
    assert licenses.known_digests(spark).count() == len({d for _, d in licenses.KNOWN})
