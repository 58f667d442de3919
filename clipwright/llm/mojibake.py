"""Problem 10: text decoded with the wrong encoding, found and restored span by span.

Garbled sequences are computed once for every pair of a wrong decoder and a character written in
UTF-8, joined in one multi-pattern automaton, and only the spans it
matches are replaced: correct text in the same document, look-alikes of garble included, stays. The
characters of three and four bytes (emoji, other scripts) enter it by the garble of their first two
bytes, and the rest is read where they match. This goes on until nothing is left to restore, as text
may be garbled any number of times; each time it gets shorter.
Text written in a Turkish code page of one byte and read with a decoder of another script or of
symbols is found by words that mix such a character with ASCII letters, and restored in the run of
characters around them that the decoder can yield (look-alikes of problem 4 may stand between).
Single letters that a Turkish code page yields when read as a Western one (þ for ş) are letters of
other languages too, so each sentence is judged by its other letters and common words, by those of
its neighbours where it has none, then by the document's; where nothing speaks for another language,
two such letters are garble. Words of Cyrillic, Greek, Hebrew or Arabic code pages read as Western
(all accented letters, several in a row) are restored by the page whose common letters they show most.

Defined results
  null or empty text       -> not affected, restored text is the text itself
  correct text             -> not affected
  replacement characters   -> affected, not restorable (what they stood for is gone); the rest is restored
  very long text           -> scanned whole
Repeated rows are judged each; extra columns pass through.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import spread
from .plainform import ALIKE_ALWAYS, ALIKE_IN_WORD, INVISIBLE, SPACES, compatibility, composed_alike

#: Decoders that text written in UTF-8 was wrongly read with; the first that explains a sequence wins.
WRONG_DECODERS = ("cp1252", "latin-1", "cp1254", "mac_roman", "cp850", "cp437", "cp857", "cp1250", "iso8859_2", "cp1251", "cp1253")
#: Further ones, whose sequences count only where a symbol is among them.
MORE_DECODERS = ("cp852", "koi8_r", "cp1256", "cp1257", "iso8859_15")
#: Those that show most bytes alike.
WESTERN = ("cp1252", "latin-1", "cp1254")
#: Blocks whose characters the corpus may hold.
TARGETS = ((0x00A0, 0x0250), (0x0251, 0x0262), (0x02B0, 0x0370), (0x0370, 0x0530), (0x2000, 0x2070), (0x20A0, 0x20C0), (0x2100, 0x2200), (0x3000, 0x3001), (0xFB00, 0xFB07), (0xFEFF, 0xFF5F))
#: Scripts of two bytes; a single one of them may be chance, so they count side by side.
SCRIPTS = ((0x0530, 0x0700),)
#: What the decoders of Windows and Latin pages show for 0x80 to 0x9F; beside one of them a letter is no word's.
_DAMAGE = "€‚ƒ„†‡ˆ‰‹›™˜ŸœŒžŽ" + "".join(map(chr, range(0x80, 0xA0)))
# Pages of other alphabets, and the commonest letters of a language written in each.
FOREIGN_PAGES = {"cp1251": "оеаинтсрвл", "koi8_r": "оеаинтсрвл", "cp1253": "αοιετσνηυρ", "cp1255": "יוהלאתרבמש", "cp1256": "الينمرتوبه"}
# Letters of the Turkish code page as the Western and the Central European one show them.
SINGLE = {"þ": "ş", "ý": "ı", "ð": "ğ", "Þ": "Ş", "Ý": "İ", "Ð": "Ğ", "ţ": "ş", "đ": "ğ", "Ţ": "Ş", "Đ": "Ğ"}
# Letters that speak for Turkish, and for the languages that own the letters above.
TURKISH, OTHERS = re.compile("[ışğİŞĞçÇüÜ]"), re.compile("[áíóúæøåÁÍÓÚÆØÅăĂșȘțȚčćžšČĆŽŠěřůňĚŘŮŇ]")
# Common words of Turkish, and of the languages that own the single letters, that the other side lacks.
TURKISH_WORDS = re.compile(r"\b(?:ve|bir|bu|ile|ama|gibi|olarak|sonra|daha|kadar|yok)\b", re.I)
OTHER_WORDS = re.compile(r"\b(?:að|það|við|með|eða|og|þar|þau|þeim|þess|þetta|þegar|þeir|þeirra|þessi|þannig|verið|aðeins|među|također|într|că|şi)\b", re.I)
_SINGLE = re.compile(f"[{''.join(SINGLE)}]")
_SENTENCE = re.compile(r"[^.!?…\n]*[.!?…\n]+|[^.!?…\n]+")
_LETTERS = re.compile(r"[^\W\d_]+")
LOST = "�"
_ASCII_LETTER = re.compile("[A-Za-zＡ-Ｚａ-ｚ]")  # of full width too
#: Code pages of one byte that Turkish text was written in.
TURKISH_PAGES = ("cp1254", "iso8859_9", "cp857", "mac_turkish")
#: Decoders that show a Windows page as Latin letters: SINGLE holds what they yield.
LATIN_DECODERS = ("cp1252", "latin-1", "cp1254", "cp1250", "iso8859_2")
TURKISH_LETTERS = "çğıöşüÇĞİÖŞÜâîûÂÎÛ"


class Garble(NamedTuple):
    original: str
    #: 3: only side by side with another; 2: surely garble; 1: only if a letter follows; 0: only beside sure garble of the same decoder.
    weight: int
    decoder: str


def _read(data: bytes, decoder: str) -> str:
    out = []
    for b in data:
        try:
            out.append(bytes([b]).decode(decoder))
        except UnicodeDecodeError:
            out.append(chr(b))  # undefined bytes come out as control characters
    return "".join(out)


def _misread(text: str, decoder: str) -> str:
    return _read(text.encode("utf-8"), decoder)


def _is_symbol(c: str) -> bool:
    return unicodedata.category(c) in ("So", "Sm", "Sk", "Sc", "Cc", "No") or c in "ªº†‡‰§¶"


def _is_box(g: str) -> bool:
    return all(0x2500 <= ord(c) < 0x2580 for c in g)


def _weight(c: str, g: str, decoder: str) -> int:
    if c in " \u00ad" or _is_box(g) or (decoder in ("cp1251", "cp1253") and g.isalpha() and len(g) == 2 and (g[1] in "ЁёІіЇїЎўҐґЄє" or decoder == "cp1253")):
        return 0
    if decoder in MORE_DECODERS and not any(_is_symbol(x) for x in g):
        return 0
    if len(g) == 2 and g[1] in "“”‘’‚„…–—«»·¡¿ " and g[0].isalpha():
        return 1
    if g[0] in "“”‘’–—…«»¡¿":
        return 0  # punctuation before an accented capital
    if g.isalpha() and decoder not in ("cp1252", "latin-1", "cp1254", "cp1251"):
        return 0  # accented letters side by side, as in some languages' own words
    return 2


@cache
def garbled_sequences() -> dict[str, tuple[Garble, ...]]:
    """Every garbled sequence with what it may have been: by each decoder that shows another character so."""
    chars = [chr(c) for a, b in TARGETS for c in range(a, b)]
    scripts = [chr(c) for a, b in SCRIPTS for c in range(a, b) if unicodedata.category(chr(c)) != "Cn"]
    out: dict[str, tuple[Garble, ...]] = {}

    def add(g: str, what: Garble) -> None:
        if all(what.decoder != x.decoder for x in out.get(g, ())):
            out[g] = (*out.get(g, ()), what)

    for decoder in WRONG_DECODERS + MORE_DECODERS:
        for c in chars:
            g = _misread(c, decoder)
            if not any(x.isascii() for x in g):
                add(g, Garble(c, _weight(c, g, decoder), decoder))
    for c in map(chr, range(0x80, 0xA0)):  # what text garbled more than once holds
        add(_misread(c, "latin-1"), Garble(c, 2, "latin-1"))
    for decoder in WRONG_DECODERS + MORE_DECODERS:
        for c in scripts:
            g = _misread(c, decoder)
            if not any(x.isascii() for x in g) and (decoder in WESTERN or any(_is_symbol(x) for x in g)):
                add(g, Garble(c, 3 if not _is_box(g) else 0, decoder))
    return out


@cache
def leads() -> dict[str, tuple[tuple[bytes, str], ...]]:
    """The garble of the first two bytes of every longer character, with those bytes by each decoder that shows them so."""
    out: dict[str, tuple[tuple[bytes, str], ...]] = {}
    for decoder in WRONG_DECODERS + MORE_DECODERS:
        # By the rules of UTF-8 for the second byte.
        for lead in range(0xE0, 0xF5):
            low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))
            for second in range(low, high + 1):
                g = _read(bytes([lead, second]), decoder)
                if len(g) == 2 and not any(x.isascii() for x in g) and (decoder in WESTERN or any(_is_symbol(x) for x in g)):
                    out[g] = (*out.get(g, ()), (bytes([lead, second]), decoder))
    return out


@cache
def _byte_of(decoder: str) -> dict[str, int]:
    return {_read(bytes([b]), decoder): b for b in range(0x80, 0x100)}


@cache
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    known, longer = garbled_sequences(), leads()
    for g in {**known, **longer}:
        a.add_word(g, (len(g), known.get(g, ()), longer.get(g, ())))
    a.make_automaton()
    return a


@cache
def _beginnings() -> tuple[re.Pattern, frozenset[str]]:
    """The two characters with which sequences begin that may be sure, and a pattern that finds where to look for them."""
    pairs = frozenset(g[:2] for g in [*(g for g, ways in garbled_sequences().items() if any(w.weight for w in ways)), *leads()])
    cls = lambda i: "[" + re.escape("".join(sorted({g[i] for g in pairs}))) + "]"
    return re.compile(f"{cls(0)}(?={cls(1)})"), pairs


def _possible(text: str) -> bool:
    look, pairs = _beginnings()
    return any(text[m.start() : m.start() + 2] in pairs for m in look.finditer(text))


class Page(NamedTuple):
    #: What the page's letters came out as, and the letters; those the decoder shows rightly stand for themselves.
    letters: dict[str, str]
    #: Of those, the characters that stand in no correct word of Latin letters.
    sure: frozenset[str]
    #: A sure character in a word with an ASCII letter; a run of what the decoder can yield; a word of letters and garbled letters.
    any_sure: re.Pattern
    run: re.Pattern
    word: re.Pattern
    windows: bool


@cache
def _alike() -> dict[str, str]:
    one, more = compatibility()
    return {**one, **more, **ALIKE_ALWAYS, **ALIKE_IN_WORD, **composed_alike()}


def _is_sure(c: str) -> bool:
    """Whether a character beside Latin letters is neither a Latin letter nor drawn like one nor ordinary punctuation."""
    alike = _alike().get(c, "")
    if c in INVISIBLE or c in SPACES or alike.isascii() and alike or alike in TURKISH_LETTERS and alike:
        return False
    if c.isalpha():
        return ord(c) >= 0x250
    return unicodedata.category(c) in ("So", "Sm", "Sk", "Cc", "Co") and unicodedata.normalize("NFKC", c) == c


@cache
def turkish_pages() -> tuple[tuple[Page, ...], re.Pattern]:
    """Every pair of a Turkish code page and a wrong decoder that yields sure characters, and a pattern of all of those."""
    cls = lambda cs: "[" + re.escape("".join(sorted(cs))) + "]"
    latin = _ASCII_LETTER.pattern
    out: dict[tuple, Page] = {}
    for page in TURKISH_PAGES:
        for decoder in WRONG_DECODERS:
            if page in ("cp1254", "iso8859_9") and decoder in LATIN_DECODERS:
                continue
            pairs = {_read(bytes([b]), decoder): c for b in range(0x80, 0x100) if (c := _read(bytes([b]), page)).isalpha() and ord(c) < 0x250}
            letters = {g: c for g, c in pairs.items() if c in TURKISH_LETTERS or _is_sure(g)}
            sure = frozenset(g for g, c in letters.items() if c in TURKISH_LETTERS and c != g and _is_sure(g))
            if sure:
                word = re.compile(f"(?:[^\\W\\d_]|{cls(letters)})+")
                run = {*_read(bytes(range(256)), decoder), *INVISIBLE, *(c for c in _alike() if ord(c) >= 0x250)}
                p = Page(letters, sure, re.compile(f"{latin}{cls(letters)}*{cls(sure)}|{cls(sure)}{cls(letters)}*{latin}"), re.compile(f"{cls(run)}+"), word, page in ("cp1254", "iso8859_9"))
                out.setdefault((decoder, *((c, g) for g, c in letters.items() if c in TURKISH_LETTERS)), p)
    return tuple(out.values()), re.compile(cls({c for p in out.values() for c in p.sure}))


def _page_parts(text: str, page: Page) -> tuple[tuple[int, int], list[tuple[int, int, str]]]:
    """How many words speak for this page and how many letters it explains, and the letters to replace."""
    score, parts = 0, []
    for run in page.run.finditer(text):
        if not page.any_sure.search(run[0]):
            continue
        whole = lambda m: not text[max(0, m.start() - 1) : m.start()].isalpha() and not text[m.end() : m.end() + 1].isalpha()
        words = [m for m in page.word.finditer(text, *run.span()) if not m[0].isascii() and whole(m)]
        mixed = [m for m in words if _ASCII_LETTER.search(m[0])]
        known = [m for m in mixed if all(c.isascii() or c in page.letters or c in _alike() for c in m[0])]
        others = sum(1 for m in mixed if any(c.isalpha() and ord(c) >= 0x250 and c not in page.letters and c not in _alike() for c in m[0]))
        marks = spoken = 0
        for m in known:
            w = m[0]
            if len(_ASCII_LETTER.findall(w)) < 2 or not page.any_sure.search(w):
                continue
            if any(c in page.sure and c.isalpha() for c in w):
                spoken += 1
            elif any(c in page.sure for c in w[1:-1]):
                marks += 1
        # One symbol between letters may be anything; two words with one are no chance.
        if not spoken and marks < 2 or others >= spoken + marks:
            continue
        if not page.windows and len({c for m in known for c in m[0] if c in page.sure}) < 2:
            continue
        score += spoken + marks
        # A word without an ASCII letter (üç): the other alphabet has hardly one of these letters alone.
        bare = [m for m in words if not _ASCII_LETTER.search(m[0]) and all(page.letters.get(c, "?") in TURKISH_LETTERS[:12] for c in m[0])]
        parts += [(m.start() + k, m.start() + k + 1, page.letters[c]) for m in known + bare for k, c in enumerate(m[0]) if page.letters.get(c, c) != c]
    return (score, len(parts)), sorted(parts)


def _from_pages(text: str) -> tuple[str, int]:
    """Text with what was written in a Turkish code page restored, and the letters replaced."""
    pages, any_sure = turkish_pages()
    spans = 0
    while any_sure.search(text):
        chars = set(text)
        score, parts = max((_page_parts(text, p) for p in pages if not p.sure.isdisjoint(chars) and p.any_sure.search(text)), key=lambda x: x[0], default=((0, 0), []))
        if not score[0]:
            break
        text = _replaced(text, parts)
        spans += len(parts)
    return text, spans


def _replaced(text: str, parts: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for s, e, c in parts:
        out += [text[at:s], c]
        at = e
    return "".join([*out, text[at:]])


def _votes(sentence: str) -> tuple[int, int]:
    """How many letters and common words speak for Turkish, and for another language."""
    return len(TURKISH.findall(sentence)) + len(TURKISH_WORDS.findall(sentence)), len(OTHERS.findall(sentence)) + len(OTHER_WORDS.findall(sentence))


def _beside_damage(text: str, word: re.Match) -> bool:
    """Whether a word holds or touches what only undecoded bytes leave: its letters are part of a sequence, not of a page."""
    return any(c in _DAMAGE for c in text[max(0, word.start() - 1) : word.end() + 1])


def _single_parts(text: str) -> list[tuple[int, int, str]]:
    """The single letters to replace: those of words without foreign letters in sentences that are Turkish."""
    if not _SINGLE.search(text):
        return []
    sentences = list(_SENTENCE.finditer(text))
    votes = [_votes(m[0]) for m in sentences]
    whole = tuple(map(sum, zip(*votes)))
    parts, unsure = [], []
    for k, m in enumerate(sentences):
        if not _SINGLE.search(m[0]):
            continue
        near = tuple(map(sum, zip(*votes[max(0, k - 1) : k + 2])))
        turkish, other = next((v for v in (votes[k], near, whole) if v[0] != v[1]), (0, 0))
        if turkish < other:
            continue
        found = [(w.start() + i, w.start() + i + 1, SINGLE[c]) for w in _LETTERS.finditer(text, *m.span()) if len(w[0]) > 1 and not OTHERS.search(w[0]) and not _beside_damage(text, w) for i, c in enumerate(w[0]) if c in SINGLE]
        if turkish > other:
            parts += found
        elif whole == (0, 0):
            unsure += found
    return parts + unsure if len(unsure) > 1 else parts


def _completed(ways: tuple[tuple[bytes, str], ...], rest: str) -> tuple[str, str] | None:
    """The character that begins with two known bytes, by the first decoder that shows the others too."""
    for first, decoder in ways:
        more = 1 if first[0] < 0xF0 else 2
        tail = [_byte_of(decoder).get(c, 0) for c in rest[:more]]
        if len(tail) == more and all(0x80 <= b < 0xC0 for b in tail):
            try:
                c = (first + bytes(tail)).decode("utf-8")
            except UnicodeDecodeError:
                continue
            if unicodedata.category(c) not in ("Cn", "Co", "Cs", "Cc"):
                return c, decoder
    return None


def _matches(text: str) -> list[tuple[int, int, tuple[Garble, ...]]]:
    """(start, end, what it may have been) of the garbled sequences in a text, longer characters read to their end."""
    out: list[tuple[int, int, tuple[Garble, ...]]] = []
    last = 0
    for end, (n, known, ways) in automaton().iter_long(text):
        s, e = end - n + 1, end + 1
        if s < last:
            continue
        read = _completed(ways, text[e : e + 2]) if ways and all(w.weight != 2 for w in known) else None
        if read:
            c, decoder = read
            e += len(c.encode()) - 2
            # A sequence of four bytes is no chance if a symbol is in it; one of three needs another at its side.
            known = (Garble(c, 2 if ord(c) > 0xFFFF and any(_is_symbol(x) for x in text[s + 1 : e]) else 3, decoder),)
        if known:
            out.append((s, e, known))
            last = e
    return out


def _alike_decoders(a: str, b: str) -> bool:
    return a == b or {a, b} <= {*WESTERN, "iso8859_15"}


def _garbled(text: str) -> list[tuple[int, int, str]]:
    if not _possible(text):
        return []
    matches = _matches(text)
    # A sequence that several decoders show is read by the one that explains most of the text.
    explained = Counter(w.decoder for _, _, ways in matches for w in ways if w.weight)
    found = [(s, e, *max(ways, key=lambda w: explained[w.decoder])) for s, e, ways in matches]
    sure = []
    for k, (s, e, _, w, how) in enumerate(found):
        beside = [found[j] for j in (k - 1, k + 1) if 0 <= j < len(found)]
        near = any(_alike_decoders(x[4], how) and (x[1] == s or x[0] == e) and x[3] >= 2 for x in beside)
        sure.append(w == 2 or (w == 1 and text[e : e + 1].isalpha()) or (w == 3 and near and any(_is_symbol(c) for c in text[s:e])))
    decoders = {x[4] for x, y in zip(found, sure) if y}
    return [(s, e, c) for (s, e, c, _, how), y in zip(found, sure) if y or any(_alike_decoders(how, d) for d in decoders)]


_FOREIGN = re.compile(r"[À-ÿ]{3}[\s.,;:!?()«»\"-]+[À-ÿ]")


@cache
def _foreign_words() -> re.Pattern:
    """Three words or more, in which every letter is an accented Western one, one of them three letters long."""
    word = r"(?:[À-ÿ¨¸³²ºª¿¯´]|(?<=[À-ÿ])[ƒ¡¢£¥](?=[À-ÿ]))+"
    return re.compile(rf"(?<![^\W\d_])(?:{word}[\s.,;:!?()«»\"-]+){{2,}}{word}(?![^\W\d_])|(?<![^\W\d_])[À-ÖØ-öø-ÿ]{{4,}}[\s.,;:!?()«»\"-]+[À-ÿ]{{4,}}(?![^\W\d_])")


def _from_foreign_pages(text: str) -> tuple[str, int]:
    """Text with words of another alphabet's code page restored where they were read as Western, and their number."""
    spans = 0
    if not _FOREIGN.search(text):
        return text, 0

    def restored(m: re.Match) -> str:
        nonlocal spans
        run = m[0]
        letters = [c for c in run if ord(c) >= 0xC0]
        if len(letters) < 8:
            return run
        best, most = run, 0.0
        for page, common in FOREIGN_PAGES.items():
            try:
                seen = "".join(c if c.isascii() or c in "«»" else bytes([ord(c)]).decode(page) for c in run if ord(c) < 0x100)
            except UnicodeDecodeError:
                continue
            got = [c for c in seen if c.isalpha() and not c.isascii()]
            cased = sum(a.islower() and b.isupper() for a, b in zip(seen, seen[1:]))
            share = sum(c.lower() in common for c in got) / len(got) if len(got) == len([c for c in run if not c.isascii() and c not in "«»"]) and got and not cased else 0.0
            if share > most:
                best, most = seen, share
        if most < 0.45 or len(best) != len(run):
            return run
        spans += len(run.split())
        return best

    return _foreign_words().sub(restored, text), spans


def repair(text: str | None) -> tuple[str | None, int, bool]:
    """The restored text, the number of garbled spans, and whether all of it could be restored."""
    if not text or text.isascii():
        return text, 0, True
    lost = text.count(LOST)
    spans = 0
    while parts := _garbled(text):
        text = _replaced(text, parts)
        spans += len(parts)
    # Letters that other scripts share with the Latin decoders are read last: þ is ş of one page, ç of another.
    text, more = _from_pages(text)
    text, foreign = _from_foreign_pages(text)
    singles = _single_parts(text)
    return _replaced(text, singles), spans + more + foreign + len(singles) + lost, not lost


def _restore(batches: Iterator[pa.RecordBatch], text: str, keep: list[str], schema: pa.Schema, only_affected: bool, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [repair(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
        rows = [i for i, g in enumerate(got) if g[1] or not only_affected]
        cols = [batch.column(batch.schema.get_field_index(c)).take(pa.array(rows, pa.int64())) for c in keep]
        if with_text:
            cols.append(pa.array([got[i][0] for i in rows], pa.string()))
        cols += [pa.array([got[i][1] for i in rows], pa.int32()), pa.array([got[i][2] for i in rows], pa.bool_())]
        yield pa.RecordBatch.from_arrays(cols, schema=schema)


def restored(df: DataFrame, text: str = "text", only_affected: bool = False, with_text: bool = True) -> DataFrame:
    """Add ``restored`` (unless told not to), ``garbled_spans`` and ``restorable``; they replace columns of the same name."""
    from pyspark.sql.pandas.types import to_arrow_schema

    new = [T.StructField("restored", T.StringType())] * with_text + [T.StructField("garbled_spans", T.IntegerType()), T.StructField("restorable", T.BooleanType())]
    if text in {f.name for f in new}:
        raise ValueError("the text and the new columns need different names")
    names = {f.name for f in new} | ({text} if not with_text else set())
    keep = [c for c in df.columns if c not in names]
    out = T.StructType([f for f in df.select(*(f"`{c}`" for c in keep)).schema] + new)
    arrow = to_arrow_schema(out)
    src = df.select(*(f"`{c}`" for c in dict.fromkeys([*keep, text])))
    return src.mapInArrow(lambda it: _restore(it, text, keep, arrow, only_affected, with_text), out)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return restored(docs, only_affected=True, with_text=False).select("doc_id")


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every affected document with its original text where it can be had."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return restored(docs, only_affected=True).select("doc_id", "restored", "garbled_spans", "restorable")
