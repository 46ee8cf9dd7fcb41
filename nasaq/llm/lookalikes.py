"""One consistent form for text that looks the same.

Look-alike classes come from union-find over strings and code points: the
compatibility and composition pairs of the Unicode character data (a rule over all
code points, not a list) and the short fixed lists below. The members of a class
are counted over all rows; the most frequent one represents the class; a
multi-pattern automaton (Aho-Corasick, leftmost longest match) rewrites every
other member to it.

Context decides for the lists of other scripts: a Cyrillic, Greek or Persian
letter is a look-alike only in a word that is not properly written in that script.
Emoji joiners stay. Vowel marks, superscripts, subscripts and composed accents are
ordinary.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Letters of other scripts that look like a Latin letter.
CYRILLIC = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅ", "aeopcyxijshdqwABEKMHOPCTYXIJS", strict=True))
GREEK = dict(zip("ονΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ovABEZHIKMNOPTYX", strict=True))
#: Armenian and Cherokee letters that look like a Latin letter.
ARMENIAN = dict(zip("օսհցոՕՏՍԼ", "ouhgnOSUL", strict=True))
CHEROKEE = dict(zip("ᎠᎡᎢᎥᎪᎫᎳᎷᎻᎽᏀᏃᏎᏚᏞᏟᏢᏦᏴᏒᏙ", "DRTiAJWMHYGZ4SLCPKBRV", strict=True))
#: Letters of phonetic writing that look like a plain Latin one.
PHONETIC = dict(zip("ɑɡɩʏ", "agiY", strict=True))
#: Persian and Urdu letters and digits that look like an Arabic one.
PERSIAN = dict(zip("کیہھە۰۱۲۳۷۸۹", "كيههه٠١٢٣٧٨٩", strict=True))
#: Letters and digits that only Persian or Urdu words have.
PERSIAN_ONLY = "پچژگٹڈڑںے۴۵۶"
#: Kinds of compatibility mappings that redraw a character.
REDRAWN = {"<wide>", "<narrow>", "<isolated>", "<initial>", "<medial>", "<final>", "<font>", "<noBreak>"}
#: Format characters that can be seen.
SEEN_FORMATS = set("\u0600\u0601\u0602\u0603\u0604\u0605\u06dd\u0890\u0891\u08e2\U000110bd\U000110cd")
#: Invisible characters that are not of the format category.
OTHER_INVISIBLE = "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0"
ZWJ, SELECTOR = "\u200d", "\ufe0f"
#: Controls that count as white space.
CONTROL_SPACES = set("\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85")

#: Passes over one text that no sound rewriting reaches; the members' lengths bound them in practice to a few.
MOST_PASSES = 200
WORD = regex.compile(r"[\p{L}\p{M}\p{N}\p{Cf}]+")
CROSS_NATIVE = {
    "c": (CYRILLIC, regex.compile(rf"(?![{''.join(CYRILLIC)}])\p{{Cyrillic}}")),
    "g": (GREEK, regex.compile(rf"(?![{''.join(GREEK)}])\p{{Greek}}")),
    "a": (ARMENIAN, regex.compile(rf"(?![{''.join(ARMENIAN)}])\p{{Armenian}}")),
    "k": (CHEROKEE, regex.compile(rf"(?![{''.join(CHEROKEE)}])\p{{Cherokee}}")),
    "l": (PHONETIC, regex.compile(rf"(?![{''.join(PHONETIC)}])[\u0250-\u02af]")),
    "p": (PERSIAN, regex.compile(f"[{PERSIAN_ONLY}]")),
}
CROSS = {ch: kind for kind, (twins, _) in CROSS_NATIVE.items() for ch in twins}
LATIN = regex.compile(r"[\p{Latin}0-9０-９]")
PLAIN_LATIN = regex.compile("[A-Za-z]")
EMOJI = regex.compile(r"[\p{So}\p{Sk}\u200d\ufe0f\u20e3]")


def _is_invisible(ch: str) -> bool:
    cat = unicodedata.category(ch)
    if cat == "Cf":
        return ch not in SEEN_FORMATS
    if cat == "Cc":
        return ch not in CONTROL_SPACES
    return ch in OTHER_INVISIBLE or "\ufe00" <= ch <= "\ufe0f" or 0xE0100 <= ord(ch) <= 0xE01EF or "\u180b" <= ch <= "\u180d"


@functools.lru_cache(1)
def twin_pairs() -> list[tuple[str, str]]:
    """Pairs (variant, plain form) over all code points."""
    pairs: list[tuple[str, str]] = []
    for cp in range(sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        cat = unicodedata.category(ch)
        if cat in ("Cn", "Co"):
            continue
        if _is_invisible(ch):
            pairs.append((ch, ""))
        elif cat == "Zs" and ch != " ":
            pairs.append((ch, " "))
        else:
            parts = unicodedata.decomposition(ch)
            if not parts:
                continue
            if parts.startswith("<"):
                kind = parts.split(" ", 1)[0]
                plain = unicodedata.normalize("NFKC", ch)
                if plain != ch and (kind in REDRAWN or (kind == "<compat>" and cat[0] == "L" and len(plain) > 1 and plain.isalpha())):
                    pairs.append((ch, plain))
            elif unicodedata.normalize("NFC", ch) != ch:
                pairs.append((ch, unicodedata.normalize("NFC", ch)))
            else:
                once = "".join(chr(int(x, 16)) for x in parts.split())
                for seq in {once, unicodedata.normalize("NFD", ch)}:
                    pairs.append((seq, ch))
                if len(once) == 2 and "\u0621" <= once[0] <= "\u064a":
                    # A vowel mark may stand between an Arabic letter and its hamza.
                    pairs += [(once[0] + v + once[1], ch + v) for v in map(chr, range(0x64B, 0x653))]
    for twins, _ in CROSS_NATIVE.values():
        pairs += twins.items()
    return [(v, p) for v, p in pairs if v != p]


@functools.lru_cache(1)
def classes() -> dict[str, list[str]]:
    """Transitive classes: by each member that is some variant, its class, plain forms first."""
    up: dict[str, str] = {}

    def find(x: str) -> str:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    variants = set()
    for v, p in twin_pairs():
        variants.add(v)
        a, b = find(v), find(p)
        if a != b:
            up[a] = b
    members: dict[str, list[str]] = {}
    for x in up:
        members.setdefault(find(x), []).append(x)
    for group in members.values():
        group.sort(key=lambda x: (x in variants, len(x), x))
    return {x: members[find(x)] for x in up}


def representatives(counts: dict[str, int] | None = None) -> dict[str, str]:
    """The rewriting of every member that doesn't represent its class.

    The most frequent member represents a class; without counts, and in a tie, the
    plain form does. A letter of another script than the plain form's never
    represents a class, however frequent: it stands for the plain one in some words
    only, and the plain one never for it. Invisible characters always give way to
    nothing and space forms to the space.
    """
    counts = counts or {}
    out = {}
    for x, group in classes().items():
        best = group[0] if group[0] in ("", " ") else max((m for m in group if CROSS.get(m, "p") == "p"), key=lambda m: counts.get(m, 0))
        if x != best and x:
            out[x] = best
    return out


class Rewriter:
    """Greedy rewriting of text by one automaton over all members of all classes."""

    def __init__(self, rewriting: dict[str, str]):
        self.automaton = ahocorasick.Automaton()
        for variant, best in rewriting.items():
            self.automaton.add_word(variant, (len(variant), best, variant))
        self.automaton.make_automaton()
        # A text without any of these has nothing to rewrite: the last code point of each variant.
        self.suspects = frozenset(v[-1] for v in rewriting)
        self.flags = np.zeros(sys.maxunicode + 1, bool)
        self.flags[[ord(x) for x in self.suspects]] = True

    def matches(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        """Rewritings (start, end, variant, representative) that hold in their context."""
        words: list[tuple[int, int]] | None = None
        for end, (length, best, variant) in self.automaton.iter_long(text):
            start = end + 1 - length
            if variant in (ZWJ, SELECTOR) and start and EMOJI.match(text[start - 1]):
                if variant == SELECTOR or (end + 1 < len(text) and EMOJI.match(text[end + 1])):
                    continue
            kind = CROSS.get(variant)
            if kind:
                if words is None:
                    words = [m.span() for m in WORD.finditer(text)]
                    at = 0
                while at < len(words) and words[at][1] <= start:
                    at += 1
                if not _stands_for_other(text, text[words[at][0] : words[at][1]], kind):
                    continue
            yield start, end + 1, variant, best

    def __call__(self, text: str) -> str:
        """The text in its one form; the same text if nothing is to rewrite."""
        seen = [text]
        while True:  # a rewriting can complete another member, hence again, to the fixed point
            if self.suspects.isdisjoint(text):
                break
            out, at = [], 0
            for start, end, _, best in self.matches(text):
                out.append(text[at:start])
                out.append(best)
                at = end
            if not out:
                break
            new = "".join(out) + text[at:]
            if new == text:
                break
            if new in seen:  # representatives that rewrite each other in turn: the least of the turn, wherever it was entered
                return min(seen[seen.index(new) :])
            if len(seen) > MOST_PASSES:
                raise RuntimeError("the rewriting of a text doesn't settle")
            seen.append(new)
            text = new
        return text

    def changes(self, text: str) -> bool:
        return not self.suspects.isdisjoint(text) and next(self.matches(text), None) is not None

    def suspicious(self, texts: list[str]) -> np.ndarray:
        """Positions of the texts that hold a suspect character, found for the whole batch at once."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        hits = np.flatnonzero(self.flags[points])
        return np.unique(np.searchsorted(np.cumsum(lengths), hits, side="right"))

    def all(self, texts: list[str]) -> list[str]:
        """Each text in its one form."""
        out = list(texts)
        for i in self.suspicious(texts):
            out[i] = self(texts[i])
        return out


def _stands_for_other(text: str, word: str, kind: str) -> bool:
    """Whether a letter of this kind in the word poses as a letter of another script."""
    native = CROSS_NATIVE[kind][1]
    if kind == "p":
        return not native.search(word)
    if kind == "l":
        return bool(PLAIN_LATIN.search(word)) and not native.search(word)
    if LATIN.search(word):
        return True
    if native.search(word):
        return False
    letters = regex.sub(r"[\p{M}\p{Cf}]", "", word)
    if len(letters) == 1 and kind == "g":
        return False
    return bool(regex.search(r"\p{Latin}", text)) and not native.search(text)


@functools.lru_cache(1)
def plain_rewriter() -> Rewriter:
    """Rewrites every class to its plain form. Two texts are equal under it exactly if
    they are equal under the representatives of any corpus."""
    return Rewriter(representatives())


def as_it_looks(text: str) -> str:
    return plain_rewriter()(text)


def all_as_they_look(texts: list[str]) -> list[str]:
    return plain_rewriter().all(texts)


@functools.lru_cache(4)
def _rewriter(rewriting: tuple[tuple[str, str], ...]) -> Rewriter:
    return Rewriter(dict(rewriting))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = classes()
    singles = {ord(x): x for x in known if len(x) == 1}
    variants = {v for v, _ in twin_pairs() if len(v) > 1}
    plain_forms = {x for x in known if len(x) > 1} - variants
    automata = []
    for members in (plain_forms, variants):
        automaton = ahocorasick.Automaton()
        for x in members:
            automaton.add_word(x, x)
        automaton.make_automaton()
        ends = np.zeros(sys.maxunicode + 1, bool)
        ends[[ord(x[-1]) for x in members]] = True
        automata.append((ends, automaton.iter if members is plain_forms else automaton.iter_long))
    seen: Counter[str] = Counter()
    points = np.zeros(sys.maxunicode + 1, np.int64)
    for batch in batches:
        # One stream for the batch; no member holds the line feed between two texts.
        stream = "\n".join(x for x in batch.column(0).to_pylist() if x)
        found = np.frombuffer(stream.encode("utf-32-le", "surrogatepass"), "<u4")
        got = np.bincount(found)
        points[: len(got)] += got
        for ends, matches in automata:
            if ends[found].any():
                seen.update(x for _, x in matches(stream))
    for cp in np.flatnonzero(points):
        if int(cp) in singles:
            seen[singles[int(cp)]] += int(points[cp])
    yield pa.RecordBatch.from_pydict({"member": list(seen), "n": [int(x) for x in seen.values()]}, pa.schema([("member", pa.string()), ("n", pa.int64())]))


def member_counts(texts: DataFrame) -> DataFrame:
    """Counts (member, n) of all class members over all rows of the one text column.

    In every text: a plain form of several characters wherever it occurs, also where
    two of them overlap; a variant of several characters leftmost longest, as it is
    rewritten. Nulls count nothing. There are at most as many rows as class members, some
    ten thousand, at every size of the input.
    """
    return texts.mapInArrow(_count, "member string, n long").groupBy("member").agg({"n": "sum"}).toDF("member", "n")


def corpus_rewriting(texts: DataFrame) -> dict[str, str]:
    """The rewriting by representatives that are the most frequent in this corpus."""
    return representatives({r.member: r.n for r in member_counts(texts).collect()})


def unified(df: DataFrame, key: list[str], text: str, rewriting: dict[str, str], only_changed: bool = False) -> DataFrame:
    """Rows (key..., text, unified, changed): every text in its one consistent form.

    Null texts stay null and unchanged, blank ones are no case; repeated rows stay
    repeated. With ``only_changed``, just the rows that needed it.
    """
    pairs = tuple(sorted(rewriting.items()))
    src = df.select(*key, text)
    schema = src.schema
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", unified string, changed boolean"
    n = len(key)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewriter = _rewriter(pairs)
        for batch in batches:
            texts = batch.column(n).to_pylist()
            new, changed = list(texts), [False] * len(texts)
            for i in rewriter.suspicious([t or "" for t in texts]):
                if next(rewriter.matches(texts[i]), None) is not None:
                    new[i] = rewriter(texts[i])
                    changed[i] = bool(new[i].strip())
            out = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(new, pa.string()), pa.array(changed, pa.bool_())],
                names=[*batch.schema.names, "unified", "changed"],
            )
            yield out.filter(pa.array(changed, pa.bool_())) if only_changed else out

    return src.mapInArrow(run, out_schema)
