"""The operators for training text and vectors against brute force, with their edge cases."""

import random
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import oracle
from driftmark.llm import encodings, leaks, oracles, packing, queries, splitting, vectors

VOCABULARY = queries.vocabulary()
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


# Splitting


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab. ,\n。́‍\U0001f44d", max_size=700))
def test_pieces_cover_the_paragraph(text):
    config = splitting.SplitConfig(80, 20)
    for p in splitting.paragraphs(text):
        got = splitting.split_paragraph(p, config)
        assert got[0][0] == 0 and got[-1][1] == len(p) and all(0 < b - a <= 80 for a, b in got)
        assert all(a2 <= b1 and b1 - a2 <= 20 and b2 > b1 and a2 > a1 for (a1, b1), (a2, b2) in zip(got, got[1:]))
        assert (len(got) == 1) == (len(p) <= 80)


def test_cuts_are_natural_where_possible():
    text = " ".join(f"This is sentence number {i} of the text, and it goes on." for i in range(60))
    got = splitting.split_paragraph(text, splitting.SplitConfig())
    assert all(text[:b].rstrip().endswith(".") for _, b in got) and all(b1 > a2 for (_, b1), (a2, _) in zip(got, got[1:]))
    unbroken = splitting.split_paragraph("x" * 5000, splitting.SplitConfig())
    assert all(b - a <= 1000 for a, b in unbroken)
    marked = "é" * 1500
    assert all(unicodedata.combining(marked[a]) == 0 for a, _ in splitting.split_paragraph(marked, splitting.SplitConfig()))
    with pytest.raises(ValueError):
        splitting.SplitConfig(100, 100)


def test_pieces_overlap_after_sentences_longer_than_the_overlap():
    sentence = "many words stand here one beside the other without any sign " * 2 + "up to the end."
    for text in (" ".join([sentence] * 20), "。".join(["文" * 120] * 20)):
        got = splitting.split_paragraph(text, splitting.SplitConfig())
        assert len(got) > 1 and all(80 < b1 - a2 <= 100 for (_, b1), (a2, _) in zip(got, got[1:]))
        assert all(text[a - 1].isspace() for a, _ in got[1:]) or "。" in text


def test_the_specified_overlap_is_kept_where_a_boundary_allows_it():
    config = splitting.SplitConfig()
    for text in (" ".join(["x" * 120 + " and so on."] * 30), " ".join(["y" * 150] * 40), ", ".join(["some words in a clause"] * 90), "A short one. " * 200):
        got = splitting.split_paragraph(text, config)
        shared = [b1 - a2 for (_, b1), (a2, _) in zip(got, got[1:])]
        assert len(got) > 1 and all(0 < s <= 100 for s in shared), shared
        # A word of 150 characters has no boundary within 100, so pieces begin within it.
        assert min(shared) >= (85 if text[0] == "y" else 5 if text[0] == "x" else 75), shared
    at, price = splitting.boundaries("One, two three. Four five")
    assert list(zip(at.tolist(), price.tolist())) == [(5, 6.0), (9, 12.0), (16, 0.0), (21, 12.0)]


def _brute_split(text, config):
    """The least cost over all ways to cut, without any pruning."""
    cut, price = splitting.boundaries(text)
    begin, extra = splitting._begins(text, cut, price, config)
    n = len(text)
    least = max(2, -(-(n - config.overlap) // (config.max_chars - config.overlap)))
    ideal = (n + (least - 1) * config.overlap) / least
    best = {0: (0.0, 0)}
    for at, start, cost in [*zip(cut.tolist(), begin.tolist(), (price + extra).tolist()), (n, n, 0.0)]:
        found = [c + cost + 40.0 * ((at - s) / ideal - 1.0) ** 2 for c, s in best.values() if at - s <= config.max_chars]
        if found:
            best[at] = (min(found), start)
    return best.get(n, (None,))[0]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .,", min_size=81, max_size=400))
def test_pieces_cost_least(text):
    config = splitting.SplitConfig(80, 20)
    for p in splitting.paragraphs(text):
        if len(p) > 80:
            cut, price = splitting.boundaries(p)
            begin, extra = splitting._begins(p, cut, price, config)
            costs, n = dict(zip(cut.tolist(), (price + extra).tolist())) | {len(p): 0.0}, len(p)
            least = max(2, -(-(n - 20) // 60))
            ideal = (n + (least - 1) * 20) / least
            got = sum(costs[b] + 40.0 * ((b - a) / ideal - 1.0) ** 2 for a, b in splitting.split_paragraph(p, config))
            assert abs(got - _brute_split(p, config)) < 1e-6


def test_split_documents_edge_cases(spark):
    rows = [("a", None, 1), ("b", " \n\n ", 2), (None, "x", 3), ("c", "one\r\n　\r\ntwo", 4), ("d", "y" * 30_000, 5), ("c", "one", 6)]
    df = spark.createDataFrame(rows, "document_id string, content string, position int")
    got = splitting.split_documents(df).collect()
    assert sorted((r["document_id"] or "", r["paragraph_no"], r["text"]) for r in got if r["document_id"] != "d") == [("", 0, "x"), ("c", 0, "one"), ("c", 0, "one"), ("c", 1, "two")]
    d = sorted((r["position"], r["start"], r["end"]) for r in got if r["document_id"] == "d")
    assert [p for p, _, _ in d] == list(range(len(d))) and d[-1][2] == 30_000
    assert splitting.split_documents(df.limit(0)).count() == 0


def test_current_documents(spark):
    rows = [("a", 1, False, "old"), ("a", 2, False, "new"), ("a", 2, False, "new"), ("b", 3, True, "x"), ("c", 1, None, None), ("d", None, False, "x"), (None, 1, False, "x"), ("e", 1, None, "y")]
    got = splitting.current_documents(spark.createDataFrame(rows, "id string, version int, deleted boolean, content string")).collect()
    assert sorted(map(tuple, got)) == [("a", "new"), ("e", "y")]


# Leaks


def _leak_brute(docs, items, n):
    words = {i: leaks.plain_words(t).split() for i, t, _ in items if t is not None}
    out = set()
    for d, t in docs:
        w = leaks.plain_words(t or "").split()
        runs = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
        out |= {(i, d) for i, x in words.items() if any(tuple(x[k:k + n]) in runs for k in range(len(x) - n + 1))}
    return out


def test_longest_run_beside_a_replaced_word():
    item = [f"word{i}" for i in range(40)]
    text = " ".join([*item[:14], "changed", *item[15:]])
    ((_, n, start, end, _),) = leaks.Scanner([(1, " ".join(item), None)], 13).scan(text)
    assert n == 25 and text[start:end] == " ".join(item[15:])


def test_leaks_against_brute_force(spark):
    rng = random.Random(9)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randrange(5, 40))), rng.choice([None, "Alpha beta"])) for i in range(30)] + [(40, None, None), (41, "", ""), (42, "short", "x")]
    docs = []
    for d in range(120):
        words = rng.choices(WORDS, k=rng.randrange(0, 60))
        if d % 2:
            source = rng.choice(items[:30])[1].split()
            n = rng.randrange(8, 20)
            a = rng.randrange(max(1, len(source) - n))
            part = source[a:a + n]
            words[rng.randrange(len(words) + 1):0] = [rng.choice([w, w.upper(), f"<b>{w}</b>", w[:2] + "­" + w[2:], f"\n> {w},"]) for w in part]
        docs.append((d, " ".join(words)))
    docs += [(500, None), (501, " "), (502, docs[1][1])]
    df = spark.createDataFrame([(d, t, "clash") for d, t in docs], "doc_id long, text string, item_id string")
    it = spark.createDataFrame([(i, t, a, 0) for i, t, a in items], "item_id long, item_text string, answer string, doc_id int")
    for passes in (50_000, 7):
        got = leaks.find_leaks(df, it, 13, passes).collect()
        assert {(r["item_id"], r["doc_id"]) for r in got} == _leak_brute(docs, items, 13) and len(got) == len({(r["item_id"], r["doc_id"]) for r in got})
    text = dict(docs)
    for r in got:
        words = leaks.plain_words(text[r["doc_id"]][r["start"]:r["end"]]).split()
        assert len(words) == r["n_words"] >= 13
    assert leaks.find_leaks(df.limit(0), it).count() == 0 == leaks.find_leaks(df, it.limit(0)).count()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aB1 <>/!-=\n\u00ad\u0301\u0345ßİﬁΣς한ก\u0e33ि’"), st.characters(codec="utf-8")), max_size=60))
def test_spans_are_those_of_the_words(text):
    for t in (text, f"<b{text}i>x</b><di<b>v>{text}"):
        spans = leaks.word_spans(t)
        assert [w for w, _, _ in spans] == leaks.plain_words(t).split()
        assert all(0 <= a < b <= len(t) for _, a, b in spans) and all(a[1] <= b[1] for a, b in zip(spans, spans[1:]))


def test_words():
    same = ["Über Öl, n° 5", "ÜBER öl n°5", "ü­ber <p>öl</p> n° 5", "​über\n* öl\n> n° 5"]
    assert {leaks.plain_words(t) for t in same} == {" uber ol n 5 "} and leaks.plain_words("<br/> …") == " "
    for t in same:
        assert " ".join(w for w, _, _ in leaks.word_spans(t)) == "uber ol n 5"


# Vectors


def _cloud(rng, n, width=64):
    x = rng.standard_normal((n, width)).astype(np.float32)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _brute_nearest(x, ids, k, least=None):
    out = {}
    g = np.round((x @ x.T).astype(np.float64), 6)
    for a in range(len(ids)):
        order = sorted((-g[a, b], ids[b]) for b in range(len(ids)) if b != a and (least is None or g[a, b] >= least))[:k]
        out[ids[a]] = [b for _, b in order]
    return out


def test_chi_square():
    rng = np.random.default_rng(1)
    x = (rng.standard_normal((200_000, 12)) ** 2).sum(axis=1)
    for p in (0.5, 0.95, 0.999):
        assert abs((x <= vectors.chi_square_quantile(p, 12)).mean() - p) < 0.005
    with pytest.raises(ValueError):
        vectors.SearchConfig(m=7)


def test_similar_pairs_with_copies_and_bad_rows(spark):
    rng = np.random.default_rng(2)
    x = _cloud(rng, 300)
    x[200:260] = x[:60] + 0.02 * _cloud(rng, 60)  # near copies
    x[260:300] = x[7]  # a group of equal vectors
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, [float(v) for v in x[i]], f"t{i}") for i in range(300)]
    bad = [(900, None, ""), (901, [0.0] * 64, ""), (902, [1.0] * 32, ""), (903, [], ""), (904, [float("nan")] * 64, ""), (905, [None] * 64, ""), (None, rows[0][1], "")]
    df = spark.createDataFrame(rows + rows[:50] + bad, "id long, embedding array<float>, query string")
    config = vectors.SearchConfig(p=0.9999, min_cosine=0.95, part_rows=64, leaf_rows=16)
    got = vectors.nearest(df, config)
    near = _brute_nearest(x.astype(np.float32), list(range(300)), 5, 0.95)
    held = {}
    for r in got.orderBy("query", "rank").collect():
        held.setdefault(r["query"], []).append(r["neighbour"])
    assert {q: sorted(v) for q, v in held.items()} == {q: sorted(v) for q, v in near.items() if v}
    want = {(a, b) for a, v in near.items() for b in v if a < b and a in near[b]}
    assert {(r["id_a"], r["id_b"]) for r in vectors.mutual_pairs(got).collect()} == want
    assert vectors.nearest(df.limit(0), config).count() == 0


def test_recall_of_the_nearest(spark):
    rng = np.random.default_rng(3)
    x = _cloud(rng, 1200)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(1200)], "id long, embedding array<float>")
    got = vectors.nearest(df, vectors.SearchConfig(part_rows=256, leaf_rows=32), queries=F.col("id") % 100 == 0).collect()
    near = _brute_nearest(x, list(range(1200)), 5)
    held = {}
    for r in got:
        held.setdefault(r["query"], set()).add(r["neighbour"])
    assert set(held) == set(range(0, 1200, 100)) and all(len(v) == 5 for v in held.values())
    assert np.mean([len(held[q] & set(near[q])) / 5 for q in held]) >= 0.9


# Packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 100), min_size=1, max_size=150), st.sampled_from(["norm", "dot"]))
def test_best_fit_keeps_every_constraint(sizes, rule):
    config = packing.PackConfig(100, 6, 100 * 100, rule=rule)
    sizes = np.array(sizes)
    bins = packing.best_fit(sizes, config)
    for b in range(bins.max() + 1):
        own = sizes[bins == b]
        assert 0 < len(own) <= 6 and own.sum() <= 100 and (own**2).sum() <= 100 * 100
    assert bins.max() + 1 <= 2 * max(-(-sizes.sum() // 100), -(-len(sizes) // 6)) + 1


def test_packing(spark):
    texts = ["word " * n for n in (0, 1, 5, 700, 2047, 2048, 2049, 5000)] + [None, " ", "日本語のテキスト。" * 300]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(3, texts[3], 0)] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    config = packing.PackConfig(group_rows=20)
    got = packing.pack(df, VOCABULARY, config).collect()
    encoding = packing._encoding(VOCABULARY)
    want = sum(len(encoding.encode_ordinary(t)) for _, t, _ in rows if t)
    assert sum(r["n_tokens"] for r in got) == want and {r["doc_id"] for r in got} == {r[0] for r in rows}
    per = {}
    for r in got:
        per.setdefault(r["sequence_id"], []).append(r)
    assert all(sum(r["n_tokens"] for r in v) <= 2048 and len(v) <= 64 and sorted(r["slot"] for r in v) == list(range(len(v))) for v in per.values())
    for doc in (0, 1, 2, 4):  # never cut unless longer than a sequence
        assert sum(r["doc_id"] == doc for r in got) == 1
    long = sorted((r["piece_no"], r["token_start"], r["n_tokens"]) for r in got if r["doc_id"] == 7)
    assert [(p, s) for p, s, _ in long] == [(i, i * 2048) for i in range(len(long))] and all(n == 2048 for _, _, n in long[:-1])
    assert packing.pack(df.limit(0), VOCABULARY).count() == 0
    assert packing.pack(spark.createDataFrame([(9, "<|endoftext|>")], "doc_id long, text string"), VOCABULARY).head()["n_tokens"] > 1


def test_a_binding_attention_capacity():
    config = packing.PackConfig(100, 6, 5000)
    rng = np.random.default_rng(4)
    sizes = np.concatenate([rng.integers(0, 60, 200), [80, 100, 71, 70]])
    bins = packing.best_fit(sizes, config)
    spent = [(sizes[bins == b] ** 2).sum() for b in range(bins.max() + 1)]
    alone = [b for b in range(bins.max() + 1) if spent[b] > 5000]
    # A piece that is over the capacity by itself has a sequence of its own; all others keep it.
    assert sorted(sizes[bins == b].tolist() for b in alone) == [[71], [80], [100]]
    free = packing.best_fit(sizes, packing.PackConfig(100, 6, 100 * 100))
    assert any((sizes[free == b] ** 2).sum() > 5000 and (free == b).sum() > 1 for b in range(free.max() + 1))
    with pytest.raises(ValueError):
        packing.PackConfig(attention=0)


def test_packing_wastes_little(spark, sf_dir):
    per = queries.p7_packed(spark, sf_dir).groupBy("sequence_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert max(r["n"] for r in per) <= 2048 and sum(r["n"] for r in per) > 0.95 * 2048 * len(per)


# Encodings

CLEAN = {
    "de": "Für die Änderung ist die Größentabelle der Küche zuständig, prüfen Sie außerdem die Übergabe.",
    "fr": "La procédure a été validée où l’on garde la clé d’accès, après la clôture de l’été. « Modèle n° 5 »",
    "es": "Según el área pequeña, la dirección será revisada mañana. ¿Quién pidió la contraseña número 8?",
    "pt": "A informação também será publicada após a manutenção. NÃO ALTERAR A CONFIGURAÇÃO",
    "sv": "Frågan gäller om översikten är återställd före mötet. ÅR 2022: ÖVERSIKT Ð Þ Æ Œ ½ ¼",
    "pl": "Proszę zgłosić, że łączność nr 3 została przyjęta, więc księgowość może wziąć go wcześniej.",
    "ru": "Сегодня проверка номер 6146 была проведена в конце месяца, ведёт учёт смена.",
    "ja": "台帳は早番のうちに更新されました。この通知は会議の後で確認されます（第3版）。",
    "en": "Don’t rely on the “manual” index – it’s a café §5 £20 €30 … Δt = 58 µs ± 4 └── 👍‍✅ №",
}


@pytest.mark.parametrize("lang", CLEAN)
def test_clean_text_is_left_alone(lang):
    for text in (CLEAN[lang], unicodedata.normalize("NFD", CLEAN[lang]), CLEAN[lang].upper() if lang != "ja" else CLEAN[lang]):
        assert encodings.restore(text) is None


OTHERS = {
    "cs": "Příliš žluťoučký kůň úpěl ďábelské ódy, naším cílem je škola v Brně. Škoda Auto.", "tr": "İstanbul’da Güneş doğdu; Ankara’daki çalışmalar sürüyor, ağaçlar yeşil, ışık güçlü.",
    "vi": "Nguyễn Văn Ân học tiếng Việt ở Hà Nội, và được thưởng.", "hu": "Árvíztűrő tükörfúrógép, őszinte űrhajós írók.", "ro": "Ștefan și Țepeș au mâncat în grădină; să vină și ăștia, Ăștia.",
    "el": "Το πρωί στην Αθήνα ήταν ήσυχο, είπε ο Γιώργος.", "he": "שלום עולם, זה טקסט בעברית.", "ar": "مرحبا بالعالم هذا نص عربي.", "ko": "한국어 문장은 여기 있습니다.", "th": "ภาษาไทยเป็นภาษาที่สวยงาม",
    "hi": "यह हिन्दी का वाक्य है।", "is": "Það er gott að búa á Íslandi, sagði Þórður; ÁÐUR var það.", "hr": "Čovjek je došao kući, žena čita knjigu, đak uči.", "lv": "Šī ir latviešu valoda, ļoti skaista, ģimene.",
    "sl": "Življenje je lepo, čas teče.", "uk": "Україна є великою, її мова — гарна, ґанок.", "fi": "Äiti söi pöydällä; „Ä“ ja Å–Ö.", "da": "Ø20 mm rør, ærø, på åen; Æblegrød.", "zh": "這是一個中文句子。",
    "fr": "cœlacanthe, œcuménique, phœnix ; presqu’île, entr’ouvrir «Était» À « la » É—B CAFÉ—bar", "ru": "В газете «НОВЫЙ ОСТРОВ» сказано: ДА… Я…",
}


def _shown(text, right, wrong):
    back = {b: c for c, b in encodings._to_byte(wrong).items()}
    return "".join(chr(b) if b < 0x80 else back.get(b, chr(b)) for b in text.encode(right))


@pytest.mark.parametrize("lang", OTHERS)
def test_clean_text_of_other_languages_is_left_alone(lang):
    assert encodings.restore(OTHERS[lang]) is None and encodings.restore(f"Plain words first. {OTHERS[lang]}") is None


@pytest.mark.parametrize("lang", OTHERS)
@pytest.mark.parametrize("wrong", ["cp1252", "mac_roman"])
def test_utf8_of_other_languages_is_restored(lang, wrong):
    text = OTHERS[lang]
    assert encodings.restore(_shown(text, "utf-8", wrong))[::3] == (True, text)


def test_utf8_read_as_latin1_many_times():
    latin1 = lambda t: "".join(map(chr, t.encode()))
    garbled = "Grüße aus Köln"
    for _ in range(6):
        garbled = latin1(garbled)
        assert encodings.restore(garbled)[::3] == (True, "Grüße aus Köln")


@pytest.mark.parametrize("right", ["euc_jp", "cp932"])
def test_short_words_of_two_byte_encodings(right):
    for word in ("東京", "日本語"):
        assert encodings.restore(_shown(word, right, "cp1252"))[3] == word


def test_what_stays_garbled_is_not_called_recoverable():
    assert encodings.restore("cafÃ© and lost � here")[0] is False
    assert encodings.restore("Une pièce cœlacanthe à côté") is None


@pytest.mark.parametrize("lang", [x for x in CLEAN if x != "en"])
@pytest.mark.parametrize("wrong", ["cp1252", "mac_roman", "cp1251", "cp437", "cp850"])
@pytest.mark.parametrize("times", [1, 2])
def test_round_trip_of_utf8(lang, wrong, times):
    garbled = text = CLEAN[lang].replace("½ ¼", "")
    for _ in range(times):
        table = {b: c for c, b in encodings._to_byte(wrong).items()}
        garbled = "".join(chr(b) if b < 128 else table.get(b, chr(b)) for b in garbled.encode())
    found = encodings.restore(garbled)
    assert found is not None
    if wrong == "cp1252" and times == 1:
        assert found[0] and found[3] == text


@pytest.mark.parametrize(("lang", "right", "wrong"), [("ja", "euc_jp", "cp1252"), ("ja", "cp932", "cp1252"), ("pl", "iso8859_2", "cp1252"), ("pl", "cp1250", "iso8859_2"), ("ru", "cp1251", "cp1252"), ("ru", "koi8_r", "cp1251"), ("de", "cp1252", "cp437"), ("fr", "cp1252", "mac_roman"), ("es", "mac_roman", "cp1252")])
def test_legacy_encodings(lang, right, wrong):
    text = CLEAN[lang].replace("’", "'").replace("（", "").replace("）", "").replace("¿", "").replace("« Modèle n° 5 »", "")
    table = {b: c for c, b in encodings._to_byte(wrong).items()}
    garbled = "".join(chr(b) if b < 128 else table[b] for b in text.encode(right))
    found = encodings.restore("Plain words first. " + garbled)
    assert found is not None and found[1] > 0
    if lang in ("ja", "ru"):
        assert found[3] == "Plain words first. " + text


def test_utf8_as_shift_jis_inside_a_clean_sentence():
    clean, passage = "会議の資料は明日までに送ってください。", "あの店に居た"
    wrong = "あい".encode().decode("cp932")
    assert encodings.restore(f"{clean}{wrong}{clean}")[::3] == (True, f"{clean}あい{clean}")
    lost = "これはテスト".encode().decode("cp932", "replace").replace("�", "・")
    assert encodings.restore(f"{clean}{lost}{clean}")[0] is False
    assert encodings.restore(clean) is None and encodings.restore(f"{clean}縺れた糸、繧り。{passage}") is None


@pytest.mark.parametrize("wrong", encodings.WRONG)
@pytest.mark.parametrize("right", ["euc_jp", "cp932"])
def test_two_byte_encodings_under_every_wrong_one(right, wrong):
    clean = "会議の資料は明日までに送ってください。"
    back = {b: c for c, b in encodings._to_byte(wrong).items()}
    shown = "".join(chr(b) if b < 0x80 else back[b] for b in clean.encode(right))
    assert encodings.restore(shown)[3] == clean


def test_find_garbled_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "plain"), (4, "cafÃ© plain"), (4, "cafÃ© plain"), (5, "lost � here"), (6, "entity caf&Atilde;&copy;"), (7, "fine &eacute; &amp; x"), (8, "x " * 60_000 + "grÃ¶Ã\u009fer")]
    df = spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id long, text string, encodings string")
    got = sorted((r["doc_id"], r["recoverable"], r["restored"][-12:] if r["restored"] else None) for r in encodings.find_garbled(df).collect())
    assert got == [(4, True, "café plain"), (4, True, "café plain"), (5, False, None), (6, True, "entity café"[-12:]), (8, True, "x x x größer")]
    assert encodings.find_garbled(df.limit(0)).count() == 0


# Queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf_dir, name):
    assert oracle.compare(spark, sf_dir, name, queries.QUERIES[name], oracles.ORACLES.get(name)) == ""
