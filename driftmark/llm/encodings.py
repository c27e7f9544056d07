"""Garbled text from wrong character encodings: find it and restore what can be restored.

Characters are mapped back to the bytes of a legacy encoding, an automaton over byte structure finds maximal
well-formed multibyte spans, and only those spans are decoded, as often as that helps. A span may decode to letters
of any living script; control characters may come out of it as long as a further round decodes them. Text that was
garbled from one single-byte encoding into another has no such structure; there a text counts as garbled only by
evidence of the whole text: words that no language writes so (signs between letters, scripts mixed in a word,
capitals after small letters) and one pair of encodings that explains them.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmark.session import ship

SCHEMA = "doc_id long, recoverable boolean, n_spans int, encodings string, restored string"
#: Encodings that text may wrongly have been decoded with. ``cp1252`` stands for ISO 8859-1 as well.
WRONG = ("cp1252", "mac_roman", "cp1251", "cp437", "cp850", "cp1250", "iso8859_2", "koi8_r", "cp866", "iso8859_5", "iso8859_15", "cp1254", "cp1257", "cp852", "mac_cyrillic", "mac_latin2")
#: Those under which two-byte encodings are tried on any word; the others are on odd words only.
WRONG_OFTEN = ("cp1252", "mac_roman", "cp1251", "cp437", "cp850")
CYRILLIC = {"cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic"}
#: Single-byte encodings of the languages, tried where another single-byte encoding was used instead.
RIGHT = {"latin": ("cp1252", "mac_roman", "cp850", "cp437"), "pl": ("cp1250", "iso8859_2", "cp852", "mac_latin2"), "ru": ("cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic")}
#: The letters beyond ASCII of the languages.
ALPHABETS = {
    "de": "äöüß", "fr": "àâæçéèêëîïôœùûü", "es": "áéíóúñü", "pt": "áàâãçéêíóôõúü", "sv": "åäöéàü", "pl": "ąćęłńóśźż",
    "ru": "абвгдеёжзийклмнопрстуфхцчшщъыьэюя",
}
_LETTERS = {lang: frozenset(x) for lang, x in ALPHABETS.items()}
_EDGE = frozenset("“”‘’‚„‛‟«»‹›…–—―‐‑−°§€£¥¢©®™·•¿¡ºª№×÷²³¹½¼¾±µ‰†‡¶′″→←↑↓⇒✓✔✗★☆■□▪▫●○◆◇▶►¬¦´`¨¯¸")
_INNER = frozenset("’‘ʼ‐‑–—·⁄/")
_IGNORED = {"Mn", "Me", "Cf", "Zs", "Zl", "Zp", "So", "Sk", "Co"}


#: What does not happen in words: a capital beyond ASCII after a small letter, a small letter before a capital
#: in Cyrillic, an oe ligature in other than its usual places, a dash before a last single consonant, an
#: apostrophe deep in a word; and a letter beyond ASCII where a sign of currency would stand.
_MISPLACED = re.compile("[a-zß-öø-ÿ][À-ÖØ-ÞĄĆĘŁŃŚŹŻŒ]|[а-яё][А-ЯЁ]|[a-z]œ(?![ut])|[a-z][—–][b-df-hj-np-tvxz](?![a-z])|[a-z][a-pr-z]’(?!hui)[a-z]{4}|[a-z]q’[a-z]{4}")
_BEFORE_NUMBER = re.compile("[À-ÖÙ-öù-ſ][0-9]+[^A-Za-z]*$")
_SIGNS = frozenset("’‘“”–—…£€§°")


@cache
def _to_byte(codec: str) -> dict[str, int]:
    """The bytes from 0x80 by the characters they stand for; C1 controls too, where a byte is undefined."""
    out: dict[str, int] = {}
    for b in range(0x80, 0x100):
        out.setdefault(chr(b), b) if codec in ("cp1252", "cp1250", "cp1254", "cp1257") and b < 0xA0 else None
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    return out


def _cls(table: dict[str, int], low: int, high: int) -> str:
    return "[" + "".join(re.escape(c) for c, b in table.items() if low <= b <= high) + "]"


@cache
def _utf8_spans(codec: str) -> re.Pattern[str]:
    """The automaton of well-formed UTF-8 over the characters that its bytes look like in ``codec``."""
    t = _to_byte(codec)
    c = _cls(t, 0x80, 0xBF)
    three = f"{_cls(t, 0xE0, 0xE0)}{_cls(t, 0xA0, 0xBF)}{c}|{_cls(t, 0xE1, 0xEF)}{c}{c}"
    four = f"{_cls(t, 0xF0, 0xF0)}{_cls(t, 0x90, 0xBF)}{c}{c}|{_cls(t, 0xF1, 0xF4)}{c}{c}{c}"
    return re.compile(f"(?:{_cls(t, 0xC2, 0xDF)}{c}|{three}|{four})+")


@cache
def _japanese_spans(codec: str, right: str) -> re.Pattern[str]:
    """The automata of EUC-JP and Shift JIS over characters of ``codec``; ASCII trail bytes are allowed."""
    t = _to_byte(codec)
    if right == "euc_jp":
        return re.compile(f"(?:{_cls(t, 0xA1, 0xFE)}{_cls(t, 0xA1, 0xFE)}|{_cls(t, 0x8E, 0x8E)}{_cls(t, 0xA1, 0xDF)})+")
    lead = f"[{_cls(t, 0x81, 0x9F)[1:-1]}{_cls(t, 0xE0, 0xEF)[1:-1]}]"
    trail = f"[{_cls(t, 0x80, 0xFC)[1:-1]}@-~]"
    return re.compile(f"(?:{lead}{trail}|{_cls(t, 0xA1, 0xDF)})+")


def _bytes(span: str, codec: str) -> bytes | None:
    t = _to_byte(codec)
    try:
        return bytes(ord(c) if c < "\x80" else t[c] for c in span)
    except KeyError:
        return None


def _kana(c: str) -> bool:
    return "ぁ" <= c <= "ヾ"


def _japanese(c: str) -> bool:
    return "　" <= c <= "ヿ" or "一" <= c <= "鿿" or "！" <= c <= "￮" or "㐀" <= c <= "䶿"


#: Scripts in living use whose letters a span may decode to, and those of them with two bytes a letter in UTF-8.
SCRIPTS = frozenset("LATIN CYRILLIC GREEK HEBREW ARABIC ARMENIAN GEORGIAN HANGUL THAI LAO KHMER MYANMAR DEVANAGARI BENGALI TAMIL TELUGU GUJARATI GURMUKHI KANNADA MALAYALAM SINHALA TIBETAN ETHIOPIC CJK HIRAGANA KATAKANA".split())
TWO_BYTES = frozenset("CYRILLIC GREEK HEBREW ARABIC ARMENIAN".split())


@cache
def _script(c: str) -> str:
    return unicodedata.name(c, "?").split(" ")[0].split("-")[0]


@cache
def _common(c: str) -> bool:
    """Characters that one span may decode to without any letter around it to confirm it."""
    o = ord(c)
    if o < 0x180:
        return o < 0x80 or 0xA0 <= o < 0x100 or c.lower() in "ąćęłńśźżœÿ"
    return c == "ƒ" or 0x300 <= o <= 0x36F or 0x2000 <= o <= 0x2044 or 0x20A0 <= o <= 0x20BF or 0x2100 <= o <= 0x23FF or 0x2500 <= o <= 0x27BF or o in (0xFE0E, 0xFE0F, 0xFEFF, 0xFFFD) or 0x1F000 <= o <= 0x1FAFF


def _plausible(got: str, before: str, after: str, codec: str, lenient: bool) -> bool:
    """Whether text that a span decodes to may be what stood there, by the number and script of its letters.

    Two letters of one script do; a single one does where no chance reading comes to it: from three bytes, beside
    letters of the same word, or (``lenient``) beside other garbled words.
    """
    kinds = [unicodedata.category(c) for c in got]
    if any(k in ("Cn", "Co", "Cs") for k in kinds) or any(k == "Cc" and not "\x80" <= c <= "\x9f" for k, c in zip(kinds, got)):
        return False
    rare = [c for c in got if not _common(c) and not "\x80" <= c <= "\x9f"]
    if not rare:
        return True
    letters = [c for c, k in zip(got, kinds) if k[0] in "LM" and not _common(c)]
    scripts = {"CJK" if _japanese(c) else _script(c) for c in letters}
    if not letters or not scripts <= SCRIPTS or len(scripts) > 1 and not lenient:
        return False
    if "LATIN" in scripts:
        if any(not (c < "\u0180" or c in "ƠơƯưȘșȚț" or "\u1e00" <= c <= "\u1eff") for c in letters if _script(c) == "LATIN"):
            return False
        return lenient or len(got) > 1 or got >= "\u1e00" or before.isascii() and before.isalpha() or "a" <= after <= "z"
    if "CJK" in scripts:
        return lenient or any(map(_kana, got)) or sum(map(_japanese, got)) >= 3
    if scripts & TWO_BYTES:
        return lenient or len(letters) >= 2
    return True


def _decode_spans(text: str, codec: str, lenient: bool) -> str:
    """Decode the UTF-8 spans of ``text`` whose characters were read with ``codec``."""

    def repaired(m: re.Match[str]) -> str:
        raw = _bytes(m.group(), codec)
        try:
            got = raw.decode("utf-8") if raw is not None else None
        except UnicodeDecodeError:
            return m.group()
        before, after = text[max(m.start() - 1, 0):m.start()], text[m.end():m.end() + 1]
        if got is None or not _plausible(got, before, after, codec, lenient):
            # Characters of many scripts beside each other are right if they are garbled text again.
            deeper = _decode_spans(got, codec, lenient) if got else ""
            return deeper if got and deeper != got and _plausible(deeper, before, after, codec, lenient) else m.group()
        # Under Cyrillic encodings plain words can be well-formed by chance: signs among the letters tell, or
        # Latin letters around what decodes to one.
        if not lenient and codec in CYRILLIC and not any(unicodedata.category(c) in ("So", "Sm", "Cc") for c in m.group()):
            within = all(_script(c) == "LATIN" for c in got) and any(map(_ASCII_LETTER.match, before + after))
            if not within and (len(got) < (2 if any(not c.isalpha() for c in m.group()) else 3) or not all(c.isalpha() and _script(c) != "LATIN" for c in got)):
                return m.group()
        return got

    return _utf8_spans(codec).sub(repaired, text)


_ASCII_LETTER = re.compile("[A-Za-z]")
#: The first bytes of the kanji in everyday use.
_EVERYDAY = {"euc_jp": (0xB0, 0xCF), "shift_jis": (0x88, 0x97)}


def _decode_japanese(text: str, codec: str, right: str, lenient: bool, everyday: bool = False) -> str:
    """Decode the spans of a two-byte encoding that give Japanese: four characters with kana among them, with
    ``lenient`` any, with ``everyday`` two kanji in everyday use."""

    def repaired(m: re.Match[str]) -> str:
        raw = _bytes(m.group(), codec)
        if raw is None:
            return m.group()
        try:
            got = raw.decode("cp932" if right == "shift_jis" else right)
        except UnicodeDecodeError:
            return m.group()
        full = [c for c in got if not c.isascii()]
        sound = all(_japanese(c) and not "｡" <= c <= "ﾟ" for c in full)
        low, high = _EVERYDAY[right]
        few = everyday and len(full) >= 2 and len(raw) == 2 * len(full) and all(low <= b <= high for b in raw[::2])
        return got if sound and full and (lenient or few or len(full) >= 4 and any(map(_kana, full))) else m.group()

    return _japanese_spans(codec, right).sub(repaired, text)


#: Well-formed UTF-8 that starts beyond ASCII; ASCII may follow, as Shift JIS takes it for trail bytes.
_UTF8 = re.compile(rb"([\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xef][\x80-\xbf]{2}|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf4][\x80-\xbf]{3})[\x00-\x7f]*")
#: What the first two bytes of kana in UTF-8 look like in Shift JIS.
_KANA_LEADS = re.compile("[縺繧繝]")
#: One of those whose last byte was lost or became a plain character.
_KANA_LOST = re.compile("[縺繧繝](?:[・?？�]|$)")


@lru_cache(maxsize=100_000)
def _cp932(c: str) -> bytes | None:
    try:
        return c.encode("cp932")
    except UnicodeEncodeError:
        return None


def _decode_cp932(text: str) -> str:
    """Decode the maximal spans of ``text`` that are well-formed UTF-8 over the bytes of Shift JIS, begin and end
    between its characters and hold kana: two or more, or one whose last byte looks like half-width kana. The
    middle dot ends a span, as it stands for lost bytes."""
    out: list[str] = []
    i = 0
    while i < len(text):
        raw, ends = b"", {}
        if not text[i].isascii() and (first := _cp932(text[i])) and first[0] >= 0xC2:
            for j in range(i, len(text)):
                if text[j].isascii() or text[j] == "・" or (b := _cp932(text[j])) is None:
                    break
                raw += b
                ends[len(raw)] = j + 1
        at = best = 0
        while m := _UTF8.match(raw, at):
            best = max((e for e in range(m.end(1), m.end() + 1) if e in ends), default=best)
            at = m.end()
        got = raw[:best].decode("utf-8") if best else ""
        stop = ends.get(best, i)
        kana = sum(map(_kana, got))
        near = re.search("[縺繧繝][｡-ﾟ]", text[i:stop])
        if kana and (kana > 1 or near) and _KANA_LEADS.search(text[i:stop]) and _plausible(got, "", "", "cp932", True):
            out.append(got)
            i = stop
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


@lru_cache(maxsize=200_000)
def odd(word: str) -> bool:
    """Whether ``word`` cannot be a word of any of the languages: its letters fit none of the alphabets, or
    there are signs between or before its letters that do not belong into words."""
    if word.isascii():
        return False
    core = unicodedata.normalize("NFC", word)
    core = "".join(c for c in core if unicodedata.category(c) not in _IGNORED or c in "°©®¦") if not core.isalpha() else core
    if _BEFORE_NUMBER.match(core):
        return True
    a, b = 0, len(core)
    while a < b and (core[a] in _EDGE or core[a].isascii() and not core[a].isalpha()):
        a += 1
    while b > a and (core[b - 1] in _EDGE or core[b - 1].isascii() and not core[b - 1].isalpha()):
        b -= 1
    core = core[a:b]
    if _MISPLACED.search(core):
        return True
    core = core.lower()
    if len(core) < 3 or core.isascii():
        return False
    letters = {c for c in core if c.isalpha() and not c.isascii()}
    if any(map(_japanese, letters)):
        return False
    for before, c, after in zip(" " + core, core, core[1:] + " "):
        if not c.isascii() and not c.isalpha() and c not in _INNER and (before.isalpha() or after.isalpha() and not before.isdigit()):
            return True
    if not letters or "ÿ" in letters:
        return bool(letters)
    latin = any("a" <= c <= "z" for c in core)
    return not any(letters <= own and not (lang == "ru" and latin and not re.search("[-’/.]", core)) for lang, own in _LETTERS.items())


def _shape(word: str) -> int:
    """0 for lower case, capitalised or upper case, else 1."""
    letters = "".join(c for c in word if c.isalpha())
    return int(bool(letters) and not (letters.islower() or letters.isupper() or letters[:1].isupper() and (letters[1:].islower() or len(letters) == 1)))


PAIRS = tuple((group, right, wrong) for group, rights in RIGHT.items() for right in rights for wrong in WRONG if wrong != right)


@lru_cache(maxsize=500_000)
def _through(word: str, pair: tuple[str, str, str], lenient: bool = False) -> str | None:
    """``word`` read with the right one of two single-byte encodings, if that gives a word of a language;
    ``lenient`` takes short words, too."""
    group, right, wrong = pair
    if (raw := _bytes(word, wrong)) is None:
        return None
    try:
        got = raw.decode(right)
    except UnicodeDecodeError:
        return None
    changed = [c for c in got if not c.isascii()]
    if got == word or not changed or odd(got) or _shape(got) or not all(c.isalpha() or c in _EDGE or c in "\xa0…" for c in changed):
        return None
    found = {c.lower() for c in changed if c.isalpha()}
    if not found:
        return got if group == "latin" and all(c in _SIGNS for c in changed) else None
    if group == "ru" and (not found & _LETTERS["ru"] or sum(c.isalpha() for c in changed) < 3 and not lenient) or group == "pl" and not found & _LETTERS["pl"]:
        return None
    return got if any(found <= own for own in _LETTERS.values()) else None


@lru_cache(maxsize=200_000)
def _single_byte(word: str) -> tuple[str, str] | None:
    """The first repair of an odd word through two single-byte encodings, and their names."""
    for pair in PAIRS:
        if got := _through(word, pair):
            return got, f"{pair[1]} as {pair[2]}"
    return None


def _best_pair(words: list[str]) -> tuple[str, str, str] | None:
    """The two encodings that explain most of the odd words of a text, with letters of one language."""
    best, most = None, 0.0
    for pair in PAIRS:
        got = [g for w in words if (g := _through(w, pair))]
        letters = {c.lower() for g in got for c in g if c.isalpha() and not c.isascii()}
        score = len(got) + (0.5 if any(letters <= own for own in _LETTERS.values()) else 0.0) if got else 0.0
        if score > most:
            best, most = pair, score
    return best


def _left(text: str) -> int:
    """Characters beyond ASCII that are not Japanese."""
    return sum(not c.isascii() and not _japanese(c) for c in text)


def _controls(text: str) -> int:
    return sum("\x80" <= c <= "\x9f" and c != "\x85" for c in text)


def _two_bytes(text: str, codecs: Iterable[str], lenient: bool, everyday: bool = False) -> tuple[str, list[str]] | None:
    """The reading through a two-byte encoding that leaves least, if that is little."""
    found = [(_left(new), new, f"{right} as {codec}") for codec in codecs for right in ("euc_jp", "shift_jis") if (new := _decode_japanese(text, codec, right, lenient, everyday)) != text]
    if found and (best := min(found))[0] < 0.2 * _left(text):
        return best[1], [best[2]]
    return None


def _multibyte(text: str, lenient: bool) -> tuple[str, list[str]]:
    """All repairs through multibyte structure, repeated while they change anything; each makes the text shorter.

    A round may bring out control characters for the next to decode. If some stay, what counts is the last round
    that left none, or the last one if there were as many before.
    """
    if len(text) >= 8 and (two := _two_bytes(text, WRONG if odd(text) else WRONG_OFTEN, lenient)):
        return two  # it may hold well-formed UTF-8 by chance: the better reading wins
    rounds: list[tuple[str, list[str]]] = [(text, [])]
    while True:
        before, names = rounds[-1]
        # The encoding that explains most, the first of equals.
        _, _, codec, now = min((len(new), i, codec, new) for i, codec in enumerate(WRONG) if (new := _decode_spans(before, codec, lenient)) is not None)
        name = f"utf-8 as {codec}"
        if now == before and _KANA_LEADS.search(before):
            try:
                now = before.encode("cp932").decode("utf-8") if "・" not in before else _decode_cp932(before)
            except UnicodeError:
                now = _decode_cp932(before)
            name = "utf-8 as shift_jis"
        if now == before or len(now) >= len(before):
            break
        rounds.append((now, [*names, name]))
    # Few kanji without kana count if nothing else explains a word that no language writes.
    if len(rounds) == 1 and len(text) >= 4 and odd(text) and not _ASCII_LETTER.search(text) and (two := _two_bytes(text, [c for c in WRONG if c not in CYRILLIC], lenient, True)):
        return two
    clear = [r for r in rounds if not _controls(r[0])]
    return clear[-1] if clear else rounds[-1] if _controls(rounds[-1][0]) <= _controls(text) else rounds[0]


_CONTROL = re.compile("[\x80-\x84\x86-\x9f]")
_PLAIN = re.compile("[　-ヿ一-鿿！-｠A-Za-z0-9.,;:!?()\\-'\"/%]+")


_DASHED = re.compile("[a-z]{3}[—–][b-df-hj-np-tvxz](?![a-z])")
_MIXED = re.compile("[A-Za-zÀ-ÖØ-öø-ſ][Ͱ-ӿ]|[Ͱ-ӿ][A-Za-zÀ-ÖØ-öø-ſ]")


@lru_cache(maxsize=200_000)
def impossible(word: str) -> bool:
    """Whether no language writes ``word``: a sign between two letters, two scripts side by side, a capital
    beyond ASCII after a small letter, accented letters only, a letter where a number has its currency, a dash before
    a last consonant, a control character. Letters that are merely foreign to a language are not impossible."""
    core = unicodedata.normalize("NFC", word)
    if _BEFORE_NUMBER.match(core) or _DASHED.search(core) or _MIXED.search(core) or _CONTROL.search(core):
        return True
    if any(before.islower() and c.isupper() and not c.isascii() for before, c in zip(core, core[1:])):
        return True
    letters = [c for c in core if c.isalpha()]
    if len(letters) >= 4 and all("\x80" < c < "\u0180" for c in letters):
        return True
    for before, c, after in zip(core, core[1:], core[2:]):
        kind = unicodedata.category(c)
        if not c.isascii() and before.isalpha() and after.isalpha() and (kind == "Lm" and c not in _INNER or not c.isalpha() and c not in _INNER and kind not in _IGNORED - {"So", "Sk"}):
            return True
    return False


@lru_cache(maxsize=200_000)
def judge(word: str) -> tuple[str, str] | None:
    """What is wrong with a word (of a text split at ASCII white space) by its own structure: its repair and the
    encodings, the repair empty where the original is lost; None for a word that may stand as it is."""
    if word.isascii() or (_PLAIN.fullmatch(word) and not re.search("[縺繧繝]", word)):
        return None
    got, names = _multibyte(word, False)
    if names:
        return got, ", ".join(names)
    if "�" in word or _CONTROL.search(word) or _KANA_LOST.search(word):
        return "", "lost"
    return None


def _through_one_pair(words: list[str]) -> tuple[dict[str, tuple[str, str]], tuple[str, str, str] | None]:
    """The repairs of a text's odd words through single-byte encodings, by the evidence of all of them, and the pair.

    One pair of encodings must explain half of them, and some of those must be impossible as they stand: words
    whose letters are merely foreign to the languages known here are no evidence, however many.
    """
    repairable = [w for w in words if _single_byte(w)]
    pair = _best_pair(repairable) if repairable else None
    if pair is None:
        return {}, None
    explained = [w for w in words if _through(w, pair)]
    if len(explained) < 0.5 * len(words) or not any(map(impossible, explained)):
        return {}, None
    name = f"{pair[1]} as {pair[2]}"
    out = {w: (_through(w, pair) or "", name) for w in explained}
    return out | {w: _single_byte(w) for w in repairable if w not in out and impossible(w)}, pair  # type: ignore[return-value]


def _words(text: str) -> list[str]:
    return text.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ")


_ENTITY = re.compile("&(?:#[0-9]{1,6}|#x[0-9a-fA-F]{1,6}|[A-Za-z]{2,8}[0-9]{0,2});")


def restore(text: str) -> tuple[bool, int, str, str | None] | None:
    """(recoverable, number of garbled words, encodings, restored text), or None for a text in order.

    Character references are read first, as text may have been garbled before it was escaped.
    """
    shown = html.unescape(text) if "&" in text and _ENTITY.search(text) else text
    if shown.isascii():
        return None
    words = {w for w in _words(shown) if not w.isascii()}
    bad = {w: v for w in words if (v := judge(w))}
    all_odd = sorted(w for w in words if odd(w))
    through, pair = _through_one_pair(all_odd)
    if pair and len(through) <= 2 * sum(bool(got) for got, _ in bad.values()):
        through, pair = _through_one_pair([w for w in all_odd if w not in bad or not bad[w][0]])
    elif pair:  # what else was found are chance readings
        bad = {w: v for w, v in bad.items() if not v[0]}
    bad |= through
    if not bad:
        return None
    names = sorted({n for _, v in bad.values() for n in v.split(", ")})
    two_byte = [n.split(" as ") for n in names if n.startswith(("euc_jp", "shift_jis"))]
    codecs = sorted({n.split(" as ")[1] for n in names if n.startswith("utf-8 as ")} & set(WRONG))
    counted = Counter(n for w, (got, name) in bad.items() for n in name.split(", ") if got and n.startswith("utf-8 as "))
    main = max(counted, key=lambda n: (counted[n], n)).split(" as ")[1] if counted else ""
    if main in WRONG:  # a word that alone reads otherwise, too, is read like the others where that explains it better
        for w, (got, name) in bad.items():
            if got and main not in name and len(other := _decode_spans(w, main, True)) <= len(got):
                bad[w] = (other, f"utf-8 as {main}")
    out, n = [], 0
    for line in re.split("(\n)", shown):
        parts = re.split("([ \r\t]+)", line)
        garbled = any(p in bad for p in parts)
        for p in parts:
            if p in bad:
                n, p = n + 1, bad[p][0] or p
                for right, codec in two_byte:
                    p = _decode_japanese(p, codec, right, True)
            elif garbled and not p.isascii():  # beside garbled words less evidence is enough
                for codec in codecs:
                    p = _decode_spans(p, codec, True)
                if pair and not codecs and not any(map(_japanese, p)):
                    p = _through(p, pair, True) or p
            out.append(p)
    done = "".join(out)
    lost = "�" in done or _CONTROL.search(done) is not None or _KANA_LOST.search(done) is not None
    # What was garbled is whole again only if no word of it looks garbled still.
    lost = lost or any(w in bad or judge(w) for w in set(_words(done)) if not w.isascii())
    return not lost, n, ", ".join(names), done if done != text else None


def find_garbled(texts: DataFrame) -> DataFrame:
    """The texts that were decoded wrongly somewhere: (``doc_id``, ``recoverable``, ``n_spans``, ``encodings``,
    ``restored``), ``restored`` null where nothing could be restored.

    Texts of ASCII alone, without character references, cannot be garbled and are left out before Python sees them. A text is judged word by
    word where it lies, each distinct word once per worker; nothing is shuffled. Null and blank texts are in
    order. Repeated rows are judged each; other columns are ignored.
    """

    ship(texts.sparkSession)

    def judge_all(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        names = ["doc_id", "recoverable", "n_spans", "encodings", "restored"]
        kinds = [pa.int64(), pa.bool_(), pa.int32(), pa.string(), pa.string()]
        for b in batches:
            rows = [(doc, *r) for doc, t in zip(b.column(0).to_pylist(), b.column(1)) if t.is_valid and (r := restore(t.as_py()))]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    beyond_ascii = (F.octet_length("text") > F.char_length("text")) | (F.contains("text", F.lit("&")) & F.contains("text", F.lit(";")))
    return texts.select(F.col("doc_id").cast("long"), "text").filter(beyond_ascii).mapInArrow(judge_all, SCHEMA)
