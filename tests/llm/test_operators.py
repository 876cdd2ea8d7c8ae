"""The training-data operators against brute force, round trips and planted cases, on small tables with nulls, empty and long
texts, ties, repeated rows and extra columns."""

import hashlib
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import chat, common, decontaminate, fertility, html, langid, lattice, neardup, ngram_lm, pii, rans
from ledgerlens.llm.components import components

WORDS = "the of and to in a is that for it on as with be was ledger page account total paper number river stone light garden window".split()
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (r.choice([".", ",", ""]) if r.random() < 0.1 else "") + str(r.randrange(40)) * (r.random() < 0.3) for _ in range(n))


BASE = prose(1, 200)
TEXTS = [None, "", "   \n\t", "one", "a b c d", BASE, BASE, BASE.replace("river", "canal", 2), prose(2, 120), prose(3, 60) + "\n\n x  y ", "café ▁ naïve 東京 \U0001f600 <|endoftext|>", prose(4, 9000), BASE.upper()]
EXTRA = "doc_id long, text string, lang string, n_words int, kept string, start int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en" if i % 3 else None, i, "x", i) for i, t in enumerate(TEXTS)] + [(5, BASE, "en", 1, "x", 1)], EXTRA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EXTRA)


def rows(df, key="doc_id"):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: (r[key] is not None, r[key]))


def test_rans_blocks():
    freq = rans.normalise(np.array([5, 0, 1, 1000, 3]))
    assert freq.sum() == 1 << rans.BITS and freq[1] == 0 and freq[[0, 2, 3, 4]].min() > 0
    table = rans.Table(freq)
    for n in (1, 3, 127, 5000, 70_000):
        tokens = np.random.default_rng(n).choice([0, 2, 3, 4], n, p=[0.1, 0.1, 0.7, 0.1]).astype(np.uint16)
        data = rans.Block(7, [None, 3], np.array([1, n - 1]), tokens).pack(table)
        back = rans.Block.unpack(data, table)
        assert (back.tokens == tokens).all() and back.doc_ids == [None, 3] and back.start == 7
        with pytest.raises(ValueError):
            rans.Block.unpack(data[:-1] + bytes([data[-1] ^ 1]), table)
    at, rest = rans.Block.from_checkpoint(data, table, 0)
    assert at > 0 and (rest == tokens[at:]).all()


def test_rans_files(docs, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = rows(rans.op1(docs, public_tokenizers.path("byte_bpe_50k.json")))
    assert len(got) == len(TEXTS) + 1
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        ids = tok.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert rans.op1(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_strings_are_cheap():
    texts = pa.array([*(f"word{i}" for i in range(300_000)), "", "naïve 東京 \U0001f600"])
    took = []
    for f in (common.strings, pa.Array.to_pylist):
        began = time.thread_time()
        assert f(texts)[-2:] == ["", "naïve 東京 \U0001f600"]
        took.append(time.thread_time() - began)
    assert took[0] < took[1] / 2 and common.strings(texts) == texts.to_pylist()


def test_rans_white_space():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)  # with its own settings, as anyone would load it
    texts = [f"{a}{end * n}{b}" for a in ("foo", "", "x.", "7", "no, a") for b in ("bar", "", "7", "...", " y", "\u00e9t\u00e9 z") for end in ("\n", "\t", "\r\n", "\u00a0", "\x85", "\x1c") for n in range(1, 6)]
    texts += ["a\n\n\nb", "word!!!\n\n\nfoo", "\n\n\na", '"\n\xa0\xa0b', "<|endoftext|>", "a <|endoftext|>b c", "\u0120 \u0120a b", "\x00 a \x00b"]
    r = random.Random(3)
    parts = ["foo", "x.", "'s", "12", " ", " ", " ", "\n", "\n\n\n", "\t", "\r", "\u3000", "\u00a0", "\x00", "!", "<|endoftext|>", "<|endof", "\u0120", "\u200b", "\U0001f600", "\u6771\u4eac"]
    texts += ["".join(r.choice(parts) for _ in range(r.randrange(1, 14))) for _ in range(100_000)]
    assert [np.frombuffer(x, "<u2").tolist() for x in rans.Encoder(path, 5000)(pa.array(texts))] == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_fertility(docs, none):
    for r in rows(fertility.op2(docs)):
        text = TEXTS[r["doc_id"]] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = Counter(zip(words, words[1:], words[2:]))
        hit = {j for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"], r["n_symbols"]) == (len(words), sum(map(len, words)), len(hit), len(lines) - len(set(lines)), sum(text.count(c) for c in "#*$%&|<>"))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(hit) > 50 * len(words)) and not (r["kept"] and r["base_failed"])
    assert fertility.op2(none).count() == 0 and fertility.keep(docs).columns == docs.columns


def test_fertility_counts_as_the_libraries(spark):
    """Every measure and verdict again, from the libraries on whole texts and plain medians."""
    import base64

    import sentencepiece
    import tiktoken

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["    return x", " a b", "a   b", "a \n b", "a\n\n\nb", "x\u00a0 y", "end ", "\n\nx", "a\u2581b", "\u6771 \u4eac"]
    texts = [*odd, *(x + " " + prose(i, 60) for i, x in enumerate(odd)), *(prose(i, 90) + (" |" * 80 if i % 9 == 0 else "") for i in range(50)), prose(7, 5000)]
    clash = "doc_id long, text string, lang string, fertility_ int, group_ int, mid_byte_share int, kept_ int"
    table = spark.createDataFrame([(i, t, "en" if i % 2 else "de", 1, 2, 3, 4) for i, t in enumerate(texts)], clash)
    got = rows(fertility.op2(table))
    for r, t in zip(got, texts, strict=True):
        ids, n = np.array(sp.encode(t), "<u2"), len(bpe.encode_ordinary(t))
        assert (r["n_tokens"], r["chars_per_token"], r["byte_share"], r["token_entropy"]) == (n, pytest.approx(len(t) / n), pytest.approx(np.mean([sp.is_byte(int(i)) for i in ids])), pytest.approx(fertility.entropy(ids))), t
    good = [r for r in got if not r["base_failed"]]
    for r in got:
        z = {}
        for m in fertility.METRICS:
            values = np.round([x[m] for x in good if x["band_group"] == r["band_group"]], 5)
            mid = np.median(values)
            z[m] = (r[m] - mid) / max(1.4826 * np.median(np.round(np.abs(np.array([x[m] for x in good if x["band_group"] == r["band_group"]]) - mid), 5)), abs(mid) * 0.005, 1e-4)
        chars, share, bits = (z[m] for m in fertility.METRICS)
        assert r["kept"] == (not r["base_failed"] and chars + bits >= -8.5 and bits >= -12 and -14 <= chars <= 20 and share <= 25)
    kept = fertility.keep(table)
    assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["kept"]} and 0 < sum(r["kept"] for r in got) < len(good)


def test_entropy_counts_every_token():
    r = np.random.default_rng(4)
    for n in (1, 100, 127, 128, 129, 255, 256, 400):
        ids = r.integers(0, 60, n).astype("<u2")
        bits = lambda x: -sum(c / len(x) * np.log2(c / len(x)) for c in Counter(x.tolist()).values())
        width, rest = min(n, 128), n % min(n, 128)
        want = (sum(width * bits(ids[i : i + width]) for i in range(0, n - rest, width)) + rest * bits(ids[-width:])) / n
        assert fertility.entropy(ids) == pytest.approx(want)
    clean = r.permutation(128).astype("<u2")
    assert fertility.entropy(np.concatenate((clean, np.full(127, 7, "<u2")))) < 4 < 6.9 < fertility.entropy(clean)


def test_fertility_rejects_junk(spark):
    clean = [prose(i, 150) for i in range(40)]
    junk = [" | ".join(w.title() for w in prose(i, 30).split()) + " ### $$$ %%%" * 60 for i in range(100, 103)]
    got = {r["doc_id"]: r["kept"] for r in fertility.op2(spark.createDataFrame(list(enumerate(clean + junk)), "doc_id long, text string")).collect()}
    assert sum(got[i] for i in range(40)) >= 39 and not any(got[i] for i in range(40, 43))


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><article>x";</script></head><body><header class="site-header"><a href=/>Home</a></header><nav><ul><li><a>A</a></li></ul></nav>
<div class="cookie-notice">We use cookies for it and that is all there is to say about the matter of this page.</div><article><h1>A&amp;B title</h1><p>It is the first   part of the text, and <a href="x">a link</a> is in it.<p>Short.
<div class="ad">Buy the best of it now</div><aside>Side of it</aside><p>Last &eacute;nd of the article in the page&nbsp;here.</article><section id="comments"><p>I think that this is the best of all the pages.</p></section><form><button>Go</button></form><footer>&copy; x</footer></body></html>"""


def test_html(spark):
    want = "A&B title\nIt is the first part of the text, and a link is in it.\nShort.\nLast énd of the article in the page here."
    got = rows(html.op3(spark.createDataFrame([(1, "u", PAGE, 9), (2, "v", None, 9), (3, None, "", 9), (4, "w", PAGE[:700], 9)], "page_id long, url string, html string, text int")), "page_id")
    assert got[0]["text"] == want and got[0]["n_chars"] == len(want) and got[1]["text"] == got[2]["text"] == "" and got[3]["text"].startswith("A&B title")
    plain = "<div><p>" + "It is the long text of a page that has no article but all of the words in it. " * 3 + "</p><p>Also short.</p><p>" + "And the other part of it is as long as the first was, so that it is read. " * 3 + "</p></div><ul><li><a>x</a></li></ul><p>edge</p>"
    assert "Also short." in html.extract(plain) and "edge" not in html.extract(plain)


def test_html_class_words_need_appeal():
    text = ["It is the first part of the text that was written for the page and all of it is read. " * 2, "And the other part of it is as long as the first was, so that it is read as well. " * 2]
    want = "\n".join(x.strip() for x in text)
    body = "".join(f"<p>{x}</p>" for x in text)
    ad = f"<div class='ad'><p>{text[0].replace('page', 'sale') * 5}</p></div>"
    assert html.extract(f"<article><header class='entry-header'><h1>The title</h1></header>{body}{ad}</article>") == f"The title\n{want}"
    assert html.extract(f"<main><header class='header'><h1>The title</h1></header>{body}</main>") == f"The title\n{want}"
    for name in ("content no-sidebar", "has-sidebar", "elementor-widget", "sidebar", "widget wrapper", "main-header"):
        for inner in (body, f"<article>{body}</article>", f"<article>{body}{ad}</article>"):
            assert html.extract(f"<div class='{name}'>{inner}</div>{ad}<div class='site-footer'>{text[1]}</div>") == want, (name, inner)
    for name in ("comments", "comment-list", "cookie-notice", "related", "ad-slot", "sidebar", "site-footer"):
        for inner in (f"<p>{text[0].replace('page', name)}</p>", f"<article><p>{text[0].replace('page', name)}</p></article>")[: 1 + (name in ("comments", "related"))]:
            assert html.extract(f"<article>{body}</article><div id='{name}'>{inner}</div>") == want, (name, inner)
    sources = "<ul><li><a href=x>The first source of the text</a></li><li><a href=y>The second of all the sources that are in the list of the page, which is long</a></li></ul>"
    assert html.extract(f"<article>{body}{sources}</article>").split("\n")[2:] == ["The first source of the text", "The second of all the sources that are in the list of the page, which is long"]


def test_html_of_other_languages():
    other = {
        "ru": "Сегодня мы расскажем о том, как устроена система и почему она работает так хорошо на всех машинах. " * 3,
        "zh": "今天我们来谈谈系统是如何构建的以及为什么它在所有机器上都能很好地运行。" * 6,
        "rare": "Quantum chromodynamics predicts confinement; lattice simulations reproduce hadron masses, spectra, couplings, precise agreement. " * 3,
    }
    for text in other.values():
        page = f"<nav><ul><li><a href=x>{text[:30]}</a></li></ul></nav><div><h1>{text[:20]}</h1><p>{text}</p><p>{text[:15]}</p><p>{text}</p></div><div class='ad'>{text}</div><p><a href=y>{text}</a></p><footer>{text}</footer>"
        assert html.extract(page) == "\n".join(x.strip() for x in (text[:20], text, text[:15], text))


def test_html_in_linear_time():
    import time

    began = time.process_time()
    for x in ("<!", "<![CDATA[", "<?", "<a ", "<a b='", "</", "<script>", "<!--", "&#", "<p><b>", "<td>"):
        html.extract(x * 60_000)
    assert time.process_time() - began < 40


def test_html_edge_cases(spark, none):
    """Empty tables, repeated rows, columns of other names and very long pages; planted articles come back whole."""
    empty = spark.createDataFrame([], "page_id long, url string, html string, text_ int")
    assert html.op3(empty).count() == 0
    long = "".join(f"<p>It is the part {i} of the text that was written for the page, and all of it is read.</p>" for i in range(20_000))
    got = rows(html.op3(spark.createDataFrame([(1, "u", f"<article>{long}</article>", "x"), (2, "u", PAGE, None), (2, "u", PAGE, None), (None, None, "&lt;b&gt;", "y")], "page_id long, url string, html string, blocks_ string")), "page_id")
    assert got[0]["text"] == "" and got[1]["text"].count("\n") == 19_999 and got[1]["n_chars"] == len(got[1]["text"]) and got[2] == got[3]
    r = random.Random(4)
    frames = ["<nav><a href=a>{0}</a></nav>", "<header><div>{0}</div></header>", "<aside><p>{0}</p></aside>", "<div class='ad'>{0}</div>", "<footer>{0}</footer>", "<form><label>{0}</label></form>", "<section id=comments><p>{0}</p></section>", "<script>{0}</script>", "<style>{0}</style>", "<!-- {0} -->", "<div class='cookie-notice'>{0}</div>"]
    exact = 0
    for k in range(200):
        blocks = [prose(1000 + 7 * k + i, r.randrange(2, 60)) for i in range(r.randrange(1, 9))]
        junk = lambda: "".join(f.format(prose(r.randrange(10**6), r.randrange(3, 30))) for f in r.sample(frames, r.randrange(0, 5)))  # noqa: E731, B023
        inside = "".join(f"<{'p' if i else 'h1'}>{b.replace('the', '<b>the</b>')}</{'p' if i else 'h1'}>" for i, b in enumerate(blocks))
        page = f"<html><head><title>t</title></head><body>{junk()}<article>{inside}{'<div class=ad>' + prose(k, 9) + '</div>' if k % 3 == 0 else ''}</article>{junk()}</body></html>"
        exact += html.extract(page) == "\n".join(" ".join(b.split()) for b in blocks)
    assert exact == 200


def test_lattice_equals_library(spark, docs, none, tmp_path):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, model = sentencepiece.SentencePieceProcessor(model_file=path), lattice.load(path)
    for r in rows(lattice.op4(docs, model)):
        assert r["ids"] == sp.encode(TEXTS[r["doc_id"]] or "") and r["round_trip"] and r["n_tokens"] == len(r["ids"])
    assert lattice.op4(none, model).count() == 0
    assert lattice.merge("\u2581" + "abracadabra" * 30, model) == sp.encode("abracadabra" * 30)
    r = random.Random(8)
    parts = ["foo", "x.", "'s", "12", " ", " ", " ", "\n", "\t", "\r", "\u3000", ";\r", "\u2581", "\x01", "\x00", "!", "\u00e9t\u00e9", "\u6771\u4eac", "\U0001f600", "internationalisation" * 4, "  "]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(0, 14))) for _ in range(3000)]
    # small chunks, a written table, columns of all names that are used inside
    clash = "doc_id long, text string, ids_ string, Chunk_ int, chunk int, file_ int, round_trip_ string"
    spark.createDataFrame([(i, t, "kept", 5, 6, 7, "too") for i, t in enumerate(texts)], clash).repartition(3).write.parquet(f"{tmp_path}/t")
    done = lattice.decode(lattice.encode(spark.read.parquet(f"{tmp_path}/t"), model, chunk_bytes=2000, check=True), model, "ids__")
    got = rows(done)
    assert len(got) == len(texts) and done.columns == ["doc_id", "text", "ids_", "Chunk_", "chunk", "file_", "round_trip_", "ids__", "round_trip__", "decoded_"]
    for x, text in zip(got, texts, strict=True):
        assert x["ids__"] == sp.encode(text) and x["decoded_"] == text.replace("\u2581", " ") and x["round_trip__"] and (x["ids_"], x["Chunk_"], x["round_trip_"]) == ("kept", 5, "too")


def test_lattice_keeps_no_asks(spark, docs):
    from ledgerlens.llm import common

    before = len(common._written)
    lattice.encode(docs.select("doc_id", "text"), lattice.load(public_tokenizers.path("piece_bpe_32k.model")))
    kept = [path.rsplit("/", 1)[1].rsplit("-", 1)[0] for _, path in common._written[before:]]
    assert kept == ["docs", "answers"]


def test_release_reaches_executors(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    collected = lambda: sum(b.getCollectionCount() for b in beans if "Young" not in b.getName())
    before = collected()
    common.release(spark)
    assert collected() - before >= 2  # the driver's own, and the executor's, which is the same JVM here


def test_lattice_keeps_no_shuffles(spark, docs):
    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.endswith(".data")}

    docs.count()
    common.release(spark)
    time.sleep(2)
    before = shuffles()
    done = lattice.encode(docs.select("doc_id", "text"), lattice.load(public_tokenizers.path("piece_bpe_32k.model")))  # not run yet
    for _ in range(20):  # Spark deletes them in a thread of its own
        if not (left := shuffles() - before):
            break
        time.sleep(0.5)
    assert not left and done.count() == docs.count()


def test_viterbi_fold(spark):
    pieces = [("<unk>", 0.0, 2), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)), ("\u2581", -3.0, 1), *((c, -4.0, 1) for c in "abc"), ("ab", -5.0, 1), ("bc", -4.5, 1), ("abc", -9.1, 1), ("\u2581a", -5.5, 1)]
    model = lattice.Model(pieces, lattice.UNIGRAM, True)
    r = random.Random(2)
    words = ["\u2581abc", "\u2581aabcbc", "\u2581\u00e9", "abcabc", *{"".join(r.choice("abc") for _ in range(r.randrange(1, 9))) for _ in range(40)}, "abc" * 30]
    got = {r["word"]: r["ids"] for r in lattice.word_ids(spark.createDataFrame(list(enumerate(dict.fromkeys(words))), "id long, word string"), model).collect()}
    assert got == {w: brute_viterbi(w, model) if len(w) < 12 else None for w in words}
    # whole texts of a unigram model, with a word that is too long for the fold
    texts = ["abc ab\ncab", "abc" * 30 + " a", None, ""]
    done = lattice.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, check=True).orderBy("doc_id").collect()
    for r, t in zip(done, texts, strict=True):
        words = re.findall(lattice.CUT, "\u2581" + t.replace(" ", "\u2581")) if t else []
        assert r["ids_"] == [i for w in words for i in lattice.viterbi(w, model)] and r["round_trip_"]


def brute_viterbi(word, model):
    """Ids of the cheapest of all segmentations; of equal ones that whose last pieces are longest."""
    cost = {p: (c, i) for p, c, i in model.texts}

    def paths(at):
        if at == 0:
            yield 0.0, (), []
        for s in range(at):
            piece = word[s:at]
            if piece in cost or at - s == 1:
                c, ids = (cost[piece][0], [cost[piece][1]]) if piece in cost else (1e6, [model.byte_ids[b] for b in piece.encode()])
                for before, starts, found in paths(s):
                    yield before + c, (s, *starts), found + ids

    return min(paths(len(word)), key=lambda x: (round(x[0], 6), x[1]))[2]


def brute_sets(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(zip(*(words[i:] for i in range(n)))) if len(words) >= n else frozenset([tuple(words)] if words else [])


def test_near_duplicates(spark, docs, none):
    base, texts = prose(50, 150).split(), []
    for i in range(40):
        r, w = random.Random(i), list(base)
        for _ in range(i % 9):
            w[r.randrange(len(w))] = f"edit{i}"
        texts.append(" ".join(w))
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)] + [(None, base[0])], "doc_id long, text string"))
    data = [(r["doc_id"], brute_sets(r["text"])) for r in table.collect()]
    links = [[bool(a and b and i is not None and j is not None and len(a & b) >= 0.8 * len(a | b)) for j, b in data] for i, a in data]
    want = sorted((str(d), sum(x) - x[k]) for k, ((d, _), x) in enumerate(zip(data, links, strict=True)))
    got = rows(neardup.join(table))
    assert sorted((str(r["doc_id"]), r["n_links"]) for r in got) == want
    label = list(range(len(data)))
    for _ in data:
        label = [min([label[k], *(label[j] for j, hit in enumerate(x) if hit)]) for k, x in enumerate(links)]
    classes = {}
    for (d, _), k in zip(data, label, strict=True):
        classes.setdefault(k, []).append(d)
    least = {d: min(c) for c in classes.values() if None not in c for d in c}
    assert all(r["class_id"] == least.get(r["doc_id"]) for r in got)
    assert neardup.join(none).count() == 0
    kept = neardup.deduplicate(table)
    assert kept.filter("doc_id is not null").count() == len({d for d, _ in data if d is not None and least[d] == d}) and kept.filter("doc_id is null").count() == 1


def test_small_clusters_take_little_room():
    sets = [np.arange(100, dtype=np.uint64), np.arange(10, 110, dtype=np.uint64), np.arange(900, 950, dtype=np.uint64)]
    tracemalloc.start()
    links = neardup.linked(sets, np.arange(3), np.arange(3), 0.8)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert links[0, 1] and links[1, 0] and not links[2, :2].any() and not links[:2, 2].any() and most < 1e6
    assert not neardup.linked(sets[1:], np.arange(2), np.arange(2), 0.8)[0, 1]  # nothing shared


def test_near_duplicates_of_one_id(spark):
    """Different texts under one doc_id keep their own links."""
    a, b = prose(70, 100), prose(71, 100)
    table = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, b), (5, prose(72, 100))]
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in neardup.join(spark.createDataFrame(table, "doc_id long, text string")).collect())
    assert got == [(1, 1, 1), (1, 1, 2), (2, 1, 1), (3, 1, 2), (4, 1, 2), (5, 5, 0)]


def test_near_duplicates_in_small_blocks(spark):
    """A cluster over many blocks counts every link once."""
    words = prose(80, 120).split()
    texts = [" ".join([*words[:i], f"edit{i}", *words[i + 1 :]]) for i in range(60)]
    reps = neardup.Scratch(neardup.sketch(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select(F.col("doc_id").alias("rep"), F.col("doc_id").alias("least"), "set_key", F.lit(1).cast("long").alias("copies"), "signature", "bands", F.lit(7).cast("long").alias("component")), "t").read()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [brute_sets(t) for t in texts]
    want = {i: sum(len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)}
    got = neardup.verify(docs, reps.select("rep", "component", "copies", "least", "set_key"), 0.8, block=7).groupBy("rep").agg(F.sum("documents").alias("n")).collect()
    assert {r["rep"]: r["n"] for r in got} == want
    edges = neardup.surviving(reps, neardup.minima(0.8, 1e-6), block=7)
    assert {r["component"] for r in components(edges).collect()} == {0} and components(edges).count() == 60


def test_near_duplicates_have_small_plans(spark, docs, monkeypatch):
    import sys

    from ledgerlens.llm import common

    seen = []

    class Seen(common.Scratch):
        def __init__(self, df, what):
            seen.append((df._jdf.queryExecution().optimizedPlan().toString().count("Relation ["), what))
            super().__init__(df, what)

    for module in (common, neardup, sys.modules["ledgerlens.llm.components"]):
        monkeypatch.setattr(module, "Scratch", Seen)
    neardup.join(docs)
    assert max(seen)[0] <= 9, seen  # tables read by any query; each is a subtree that the driver plans
    assert common.trim_driver(spark) in (True, False)


def test_blocks_and_components(spark):
    sets = [np.unique(np.random.default_rng(i // 3).integers(0, 1 << 63, 50, dtype=np.uint64)[: 48 + i % 3]) for i in range(9)]
    got = neardup.linked(sets, np.arange(4), np.arange(4, 9), 0.8, room=20)
    assert (got == [[len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b)) for b in sets[4:]] for a in sets[:4]]).all()
    edges = [(i, i + 1) for i in range(1, 12)] + [(50, 51), (51, 51), (99, 50)] + [(i, 3000) for i in range(2000, 2300)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 13)}, 50: 50, 51: 50, 99: 50, **{i: 2000 for i in [*range(2000, 2300), 3000]}}


def test_chat(spark):
    conversations = [(1, 0, "system", "be"), (1, 1, "user", None), (1, 2, "assistant", "a\\b </turn> ### x: "), (1, 3, "user", "q"), (1, 4, "assistant", "r"), (1, 5, "user", "open"), (2, 0, "user", "only"), (3, 0, "assistant", ""), (3, 0, "assistant", ""), (None, 1, None, "n")]
    got = rows(chat.digest(chat.read_back(chat.examples(chat.with_probe(spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string"))))), "conv_id")
    probe = "\\### Assistant: </turn> ok"
    for r in got:
        turns = [(x or "", t or "") for c, _, x, t in conversations if c == r["conv_id"]] or [("user", probe), ("assistant", probe)]
        loss = "".join(t for x, t in turns if x == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), sha(loss))
    assert len(got) == 5
    first = [r for r in chat.examples(spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string")).collect() if r["conv_id"] == 1]
    assert [(len(chat.parse(r["formatted"])), chat.unescape(r["formatted"][r["loss_start"] : r["loss_end"]])) for r in first] == [(3, "a\\b </turn> ### x: "), (5, "r"), (6, "")]


def test_chat_edge_cases(spark):
    """Empty tables, a very long turn, other columns of the names used inside, and a conversation that has the probe's id."""
    kind = "conv_id long, turn long, role string, text string, formatted string, loss_start int, example int"
    assert chat.digest(chat.read_back(chat.examples(spark.createDataFrame([], kind)))).count() == 0
    long = "a </turn>\\ ### b: " * 100_000
    data = [(1, 0, "user", "q", "x", 1, 1), (1, 1, "assistant", long, None, None, None), (-7, 5, "assistant", "old", "x", 2, 2)]
    got = rows(chat.digest(chat.read_back(chat.examples(chat.with_probe(spark.createDataFrame(data, kind))))), "conv_id")
    assert [(r["conv_id"], r["n_turns"], r["loss_chars"]) for r in got] == [(-7, 3, len("\\### Assistant: </turn> ok") + 3), (1, 2, len(long))]


def test_decontamination(spark, docs, none):
    item = " ".join(BASE.split()[20:45])
    bench = spark.createDataFrame([(1, item), (2, None), (3, "one"), (4, "never seen words " * 9), (None, "a b c d"), (1, item)], "item_id long, text string")
    items = [("1", item), ("3", "one"), ("", "a b c d")]
    for blocks in (200_000, 3):
        found = rows(decontaminate.find(docs.select("doc_id", "text"), bench, block_windows=blocks).select("doc_id", "leaks_"))
        for r in found:
            w = decontaminate.words(TEXTS[r["doc_id"]])
            hit, ids = set(), set()
            for name, text in items:
                for window in decontaminate.windows(text):
                    for s in range(len(w) - len(window) + 1):
                        if tuple(w[s : s + len(window)]) == window:
                            hit.update(range(s, s + len(window)))
                            ids.add(name)
            assert (decontaminate.covered(r["leaks_"]["spans"]), set(r["leaks_"]["items"]), r["leaks_"]["n_words"]) == (len(hit), ids, len(w))
    assert decontaminate.op7(none, bench).count() == 0 and decontaminate.op7(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()}.isdisjoint({3, 4, 5, 6})
    many = spark.createDataFrame([(9, prose(2, 120))], "item_id long, text string")
    one, parts = (sorted((r["doc_id"], r["leaks_"]["items"], decontaminate.covered(r["leaks_"]["spans"])) for r in decontaminate.find(docs.select("doc_id", "text"), many, block_windows=n).collect()) for n in (10**6, 7))
    assert one == parts and any(x[2] for x in one)
    clash = docs.selectExpr("*", "1 AS leaks_", "2 AS Leaks__")
    assert decontaminate.clean(clash, bench).columns == clash.columns and decontaminate.find(clash, bench, block_windows=3).columns[-1] == "leaks___"


def test_decontamination_words():
    """Those of the contract's expression for every character, and at no more than its own time; str.translate alone took several times that."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    every = [chr(i) for i in range(0x11000) if not 0xD800 <= i < 0xE000]
    for text in [*TEXTS, "".join(every), " ".join(every), "Aa".join(every), "-".join(c + c for c in every), "\U0010ffffZ \u0130I\u212aK\x85k\xa0b\u2028c"]:
        assert decontaminate.words(text) == decontaminate.words(text and text.encode()) == [w.encode() for w in word.findall((text or "").translate(FOLD))]
    for kind in (pa.string(), pa.large_string()):
        assert decontaminate.encoded(pa.array(["é", None, "", "a B"], kind)) == ["é".encode(), None, b"", b"a B"]

    def seconds(f):
        taken = []
        for _ in range(9):
            began = time.process_time()
            f(text)
            taken.append(time.process_time() - began)
        return min(taken)

    text = "Ción, ñezco DE ciónñrr " * 5000
    assert seconds(decontaminate.words) < 2 * seconds(word.findall)


def test_language_model(docs, none):
    import math

    got = {(r["doc_id"], r["n_tokens"]): r for r in ngram_lm.op8(docs).collect()}
    token = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD)), None]
    every = [*enumerate(TEXTS), (5, BASE)]
    train = [token(t) for i, t in every if zlib.crc32(str(i).encode()) % 7 != 2]
    c, b = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(["<s>", *t], t))
    n, v, follow = sum(c.values()), len(c), Counter(h for h, _ in b)
    total = Counter()
    for (h, _), k in b.items():
        total[h] += k
    for i, t in every:
        r, words = got[i, len(token(t))], token(t)
        assert r["train_tokens"] == n and r["n_known"] == sum(c[w] > 0 for w in words)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words))
        exact = sum(math.log10((b[h, w] + 3 * follow[h] * u) / (total[h] + 3 * follow[h]) if total[h] else u) for h, w in zip(["<s>", *words], words) for u in [(c[w] + 1) / (n + v + 1)])
        assert abs(r["score"] - exact) < 0.25 * len(words) and r["score"] <= 0
    assert ngram_lm.op8(none).count() == 0
    model = ngram_lm.fit(docs.filter(~ngram_lm.held_out()))
    whole = {(r["doc_id"], r["lm_"]["n_tokens"]): r["lm_"]["score"] for r in ngram_lm.score(docs.select("doc_id", "text"), model).collect()}
    model.block_bytes = 2000  # many blocks, the same scores but for the filter's false hits
    parts = {(r["doc_id"], r["lm_"]["n_tokens"]): r["lm_"]["score"] for r in ngram_lm.score(docs.select("doc_id", "text"), model).collect()}
    assert all(abs(parts[k] - whole[k]) < 0.2 * k[1] + 1 for k in whole)


def test_language_model_counts_in_bounded_tasks(spark, docs):
    """A task merges one bucket of counts, its batches are small, and reads of words take no pairs from the files."""
    counted = ngram_lm.count(docs)
    for kind in (ngram_lm.WORDS, ngram_lm.PAIRS, ngram_lm.NEXT):
        df = counted.read(kind)
        by_file = df.groupBy(F.input_file_name().alias("f")).agg(F.countDistinct("bucket").alias("n"), F.count("*").alias("rows")).collect()
        assert len(by_file) == common.partitions(spark) and all((r["n"], r["rows"]) == (1, 1) for r in by_file)
        read = df.select("keys", "counts")._jdf.queryExecution().executedPlan().toString().split("ReadSchema:")[-1]
        assert all((f"keys_{k}" in read) == (k == kind) for k in (ngram_lm.WORDS, ngram_lm.PAIRS, ngram_lm.NEXT))
    parts = [np.random.default_rng(i).integers(0, 1 << 40, 500_000, dtype=np.uint64) for i in range(8)]
    tracemalloc.start()
    held = ngram_lm._Sum(1 << 30)
    for keys in parts:
        held.add(keys.copy(), np.ones(len(keys), np.uint32))
    keys, counts = held.merge()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = np.unique(np.concatenate(parts), return_counts=True)
    assert (keys == want[0]).all() and (counts == want[1]).all() and peak < 200_000_000


def test_language(spark, none):
    en, de = "the river and the stone of a garden that was with them", "der fluss und die steine von einem garten die mit ihnen waren"
    texts = [(i, " ".join(random.Random(i).choices((en if i % 2 else de).split(), k=60)), "en" if i % 2 else "de") for i in range(200)] + [(300, None, "en"), (301, "123 !!", "en"), (302, "", None)]
    got = langid.op9(spark.createDataFrame(texts, "doc_id long, text string, lang string")).collect()
    assert all(r["lang_pred"] == ("en" if r["doc_id"] % 2 else "de") and 0 <= r["score"] <= 1 for r in got if r["doc_id"] < 200)
    assert all((r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True) for r in got if r["doc_id"] >= 300)
    assert langid.op9(none).count() == 0


def test_language_held_out_accuracy(spark):
    """On the driver's own documents, of which a quarter is held out: the share of right languages."""
    at = "/root/testdata/sf0.01/documents.parquet"
    got = langid.op9(spark.read.parquet(at)).join(spark.read.parquet(at).select("doc_id", "lang", F.length("text").alias("n")), "doc_id").filter("held_out and lang is not null and n > 200").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in got)
    assert len(got) > 150 and right >= 0.95 * len(got), (right, len(got))


def test_language_of_few_texts_among_copies(spark):
    en, de, fr = ("the river and the stone of a garden that was with them", "der fluss und die steine von einem garten die mit ihnen waren", "le fleuve et les pierres dans un jardin qui \u00e9tait avec eux")
    text = lambda words, i: " ".join(random.Random(i).choices(words.split(), k=40))
    data = [(text(en, i), "en") for i in range(900)] + [(text(de, i), "de") for i in range(300)] + [(text(fr, i), "fr") for i in range(5)] + [(text(fr, 0), "fr")] * 40_000
    got = langid.fit(spark.createDataFrame(data, "text string, lang string"), docs_per_lang=20, dict_bytes=1 << 30)
    assert sorted(got) == ["de", "en", "fr"] and all(len(got["fr"].split(langid.letters(text(fr, i)))) == 2 for i in range(5))
    for lang, words, n in (("en", en, 900), ("de", de, 300)):
        assert sum(langid.letters(text(words, i)) in got[lang] for i in range(n)) == 20


def test_surrogates(spark, none):
    texts = [
        "Mail jo.doe12@mail.example.com or JO.DOE12@MAIL.EXAMPLE.COM, +1 (068) 555-2748 and +1-068-555-2748.", "Card 4111 1111 1111 1111 and 4111111111111111, ip 10.0.0.1!", "Mr. John Smith met Ms Smith and Mrs. MARY SMITH; Господин Иван Петров.",
        'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', None, "", "nothing here 12 3.4", "jo.doe12@mail.example.com again; 123-45-6789",
    ]
    got = {r["doc_id"]: r["text"] for r in pii.op10(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "key").collect()}
    mail = re.findall(r"\S+@\S+[a-zA-Z]", got[0] + " " + got[7])
    assert mail[0] == mail[1].lower() == mail[2] and mail[0] != "jo.doe12@mail.example.com" and re.fullmatch(r"[a-z]{2}\.[a-z]{3}\d\d@[a-z]{4}\.[a-z]{7}\.com", mail[0])
    phones = re.findall(r"\+1[-() \d]+\d", got[0])
    assert re.sub(r"\D", "", phones[0]) == re.sub(r"\D", "", phones[1]) != "10685552748" and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", phones[0])
    cards = [re.sub(" ", "", x) for x in re.findall(r"4\d{3} ?\d{4} ?\d{4} ?\d{4}", got[1])]
    luhn = sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(cards[0]))
    assert len(cards) == 2 and cards[0] == cards[1] != "4111111111111111" and luhn % 10 == 0 and "10.0.0.1" not in got[1]
    names = re.fullmatch(r"Mr\. (\w+) (\w+) met Ms (\w+) and Mrs\. (\w+) (\w+); Господин ([А-я]+) ([А-я]+)\.", got[2])
    assert names and names[2] == names[3] and names[5] == names[2].upper() and "Smith" not in got[2] and names[1] in pii.GIVEN["latin", "m"] and names[4].title() in pii.GIVEN["latin", "f"]
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', got[3]) and got[3] != texts[3] and got[4] is None and got[5] == "" and got[6] == texts[6] and "123-45-6789" not in got[7]
    assert pii.op10(none, "key").count() == 0


def test_surrogates_of_any_length(spark):
    r = random.Random(5)
    keys = ["".join(r.choice(a) for _ in range(n)) for n in (32, 128, 129, 256, 512, 3000) for a in ("0123456789abcdef", "0123456789ABCDEF", "0123456789abcdefABCDEF")]
    locals_ = ["".join(r.choice("abcxyz019._") for _ in range(n - 2)) + "zz" for n in (64, 65, 300)] + ["\u00e9" * 80, "\u00e9" + "a.b" * 40]
    mails = [f"{x.lstrip('._')}@mail.example.com" for x in locals_] + ["joe@" + "a1." * 20 + "example.com", "joe@" + "h" * 70 + ".com", "joe@mail." + "t" * 30, ".leading@mail.example.com"]
    whole = [f"a {x}, b" for x in keys + mails]
    got = [r["text"] for r in pii.op10(spark.createDataFrame([(i, t) for i, t in enumerate([*whole, f"{keys[6].upper()} {keys[6]}"])], "doc_id long, text string"), "key").orderBy("doc_id").collect()]
    for old, new in zip(keys, got, strict=False):
        assert re.fullmatch(f"a [0-9A-Fa-f]{{{len(old)}}}, b", new) and sum(a == b for a, b in zip(old.lower(), new[2:].lower(), strict=False)) < 0.4 * len(old) and (new[2:-3].islower(), new[2:-3].isupper()) == (old.islower(), old.isupper())
        assert len(old) < 256 or new[2:130].lower() != new[130:258].lower()  # digits don't repeat
    for old, new in zip(mails, got[len(keys) :], strict=False):
        assert re.fullmatch(r"a \.?[^\s@,]+@[^\s@,]+, b", new) and len(new) == len(old) + 5 and old.split("@")[0].strip(".") not in new and old.split("@")[1] not in new, (old, new)
    assert got[-1].split()[0].lower() == got[-1].split()[1] == got[6][2:-3]


def test_phones_have_one_surrogate(spark):
    digits = lambda x: re.sub(r"\D", "", x)
    same = ["+1 (068) 555-2748", "+10685552748", "+106 8555 2748", "+1-068-555-2748", "+1#068.555*2748"]
    other = ["(068) 555-2748", "+49 30 123456", "+4930123456", "+493 012 3456", "+380 44 123 4567", "+3804 412 34567"]
    got = [r["text"] for r in pii.op10(spark.createDataFrame(list(enumerate(same + other)), "doc_id long, text string"), "key").orderBy("doc_id").collect()]
    assert all(re.sub("[0-9]", "0", a) == re.sub("[0-9]", "0", b) for a, b in zip(same + other, got, strict=True))
    assert len({digits(x) for x in got[:5]}) == 1 and all(digits(x)[0] == "1" for x in got[:5]) and digits(got[0])[:4] != "1068"
    assert len({digits(x) for x in got[6:9]}) == 1 and digits(got[6])[:2] == "49" and digits(got[9]) == digits(got[10]) and digits(got[9])[:3] == "380"
    # few forms: the surrogates of all formats are distinct, and no real number
    few = [f"+1 {a}{b} {c:02d}" if a % 2 else f"+1{a}{b}{c:02d}" for a in range(3, 5) for b in range(1, 3) for c in range(0, 99, 3)]
    new = [r["text"] for r in pii.op10(spark.createDataFrame(list(enumerate(few + [x.replace(" ", "") for x in few])), "doc_id long, text string"), "k").orderBy("doc_id").collect()]
    assert len({digits(x) for x in new}) == len(few) and not {digits(x) for x in new} & {digits(x) for x in few} and [digits(x) for x in new[: len(few)]] == [digits(x) for x in new[len(few) :]]


def test_surrogates_stay_distinct(spark):
    names = [f"Mr {a}{b}" for a in "ABCDEFGH" for b in ("ak", "el", "im", "or", "us", "an", "ed", "ig")]
    out = pii.replace(spark.createDataFrame([(i, n) for i, n in enumerate(names)], "doc_id long, text string"), "k").collect()
    assert len({r["text"] for r in out}) == len(names) and not {r["text"] for r in out} & set(names)


def _replaced(spark, texts, **more):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r["text"] for r in pii.op10(table, "key").orderBy("doc_id").collect()]


def test_surrogates_keep_persons_together(spark):
    texts = [
        "Mr. John Smith met Anna. Later Smith said that John left, SMITH'S dog too, but not Smithson or john.", "Mr. John Ronald Smith and Smith", "Dr. John Smith, Prof. Eva von der Leyen: von Leyen", "Smith alone is no one",
        "Herr Müller-Lüdenscheid; Frau Kim Müller. Müller", "Господин Иван Петров: Петров и Иван, Mr O'Neill, O'Neill's", "Mr. Smith wrote to Smith@example.com",
    ]
    got = _replaced(spark, texts)
    m = re.fullmatch(r"Mr\. (\w+) (\w+) met Anna\. Later (\w+) said that (\w+) left, (\w+)'S dog too, but not Smithson or john\.", got[0])
    assert m and m[2] == m[3] and m[1] == m[4] and m[5] == m[2].upper() and m[2] != "Smith"
    n = re.fullmatch(r"Mr\. (\w+) (\w+) (\w+) and (\w+)", got[1])
    assert n and n[1] == m[1] and n[3] == n[4] == m[2] and "Ronald" not in got[1]
    d = re.fullmatch(r"Dr\. (\w+) (\w+), Prof\. (\w+) von der (\w+): von (\w+)", got[2])
    assert d and d[2] == m[2] and d[4] == d[5] != "Leyen" and got[3] == texts[3]
    assert not re.search("Müller|Lüden", got[4]) and not re.search("Петров|Иван|Neill", got[5]) and re.search("[А-я]+ и [А-я]+", got[5])
    assert re.fullmatch(rf"Mr\. {m[2]} wrote to [A-Z][a-z]{{4}}@[a-z]{{7}}\.com", got[6])


def test_surrogates_of_more_types(spark):
    mod = lambda x: int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97
    texts = ["DE89370400440532013000 and DE89 3704 0044 0532 0130 00.", "2001:db8:0:0:8:800:200c:417a or fe80::1ff:fe23", "std::cout, 12:34:56, a::b", "иван.п@почта.рф, Νίκος@example.gr", "GB29 NWBK 6016 1331 9268 19"]
    got = _replaced(spark, texts)
    one, two = re.fullmatch(r"(DE\d{20}) and (DE\d\d(?: \d{4}){4} \d\d)\.", got[0]).groups()
    assert one == two.replace(" ", "") != "DE89370400440532013000" and mod(one) == 1 and mod(got[4].replace(" ", "")) == 1 and re.fullmatch(r"GB\d\d [A-Z]{4}(?: \d{4}){3} \d\d", got[4])
    assert re.fullmatch(r"(?:[0-9a-f]{1,4}:){7}[0-9a-f]{4} or [0-9a-f]{4}::[0-9a-f]{3}:[0-9a-f]{4}", got[1]) and "2001:db8" not in got[1] and got[2] == texts[2]
    assert re.fullmatch(r"[а-я]{4}\.[а-я]@[а-я]{5}\.рф, [Α-Ω][α-ω]{4}@[a-z]{7}\.gr", got[3])


def test_surrogates_always_have_room(spark):
    letters = "abcdefghijklmnopqrstuvwxyzабвгдежз"
    mails = [f"{a}@x.com" for a in letters] + [f"{a}{b}@x.com" for a in letters[:26] for b in letters[:26]] + [f"{a}@y.org" for a in letters[:26]] + [f"{a}{b}{c}@x.com" for a in "abcd" for b in "abcdefgh" for c in "abcdefgh"]
    got = _replaced(spark, mails)
    assert len(set(got)) == len(mails) and not set(got) & set(mails) and len(mails) > 990


def test_surrogates_keep_columns(spark):
    clash = "doc_id long, text string, found_ string, new_ string, text_key_ string, attempts_ string, pii_ string, Known_ string, names_ int"
    data = [(i, t, "f", "n", "t", "a", "p", "k", 3) for i, t in enumerate(["Mr. John Smith, me@x.example.com", None, "", "Mr. Peter Smith", "Mr. Paul Smith"] * 3 + ["Mr. " + "X" + chr(97 + i) + " Smith" for i in range(26)])]
    out = pii.replace(spark.createDataFrame(data, clash), "key")
    got = rows(out)
    assert out.columns == [*(x.split()[0] for x in clash.split(", ")), "pii__"] and all(tuple(r[c] for c in out.columns[2:-1]) == d[2:] for r, d in zip(got, data, strict=True))
    assert [r["text"] for r in got[:5]] == [r["text"] for r in got[5:10]] and got[1]["text"] is None and got[2]["text"] == "" and all("Smith" not in (r["text"] or "") for r in got)
    with pytest.raises(ValueError):
        pii.replace(out, "")


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert done.count() == 0 and done.columns == ["doc_id", "ids", "n_tokens", "round_trip"]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    texts = [prose(i, 120) for i in range(30)]
    item = " ".join(texts[3].split()[5:30])
    data = list(enumerate(texts)) + [(30, texts[4]), (31, "too short"), (32, None), (33, texts[5] + " me@x.example.com")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == set(range(30)) - {3} and all(r["round_trip"] for r in got)
