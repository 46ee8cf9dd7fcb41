"""Abusive, hateful and sexually explicit language.

A weighted lexicon of single words is matched by Aho-Corasick after folding:
look-alike letters, digits in place of letters, stretched letters, marks between
letters, letters spelled one by one, starred letters. A word weighs little alone (a
dog, a bed, to kill) and much beside a cue of its kind: an insult that is addressed, a
threat that is aimed at somebody, a word that takes the humanity of a group, a
bodily word that solicits. Words of teaching, medicine, art, quotation and things
are the exceptions: near them a part of the weight stays. The score is the weight of
the worst passage by its length, and a document is marked from a score on that is
fitted on all labelled documents.
"""

from __future__ import annotations

import bisect
import functools
import re
import sys
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasaq.llm.lookalikes import all_as_they_look, as_it_looks
from nasaq.session import stored

#: Words that insult somebody they are said to. Arabic words are stems, see ``arabic_forms``.
INSULTS = """
idiot moron imbecile fool clown loser jerk pig dog trash garbage scumbag bastard bitch coward parasite scum asshole dumbass retard liar thief cretin dimwit
halfwit blockhead dunce donkey monkey rat snake worm maggot vermin creep pervert whore slut bum swine dirtbag lowlife airhead nobody disgrace stupid
dumb pathetic worthless disgusting filthy useless ugly ignorant brainless spineless
crétin imbécile salaud connard abruti ordure idiota imbécil estúpido cabrón gilipollas basura payaso dummkopf idioten vollidiot arschloch schwein mistkerl
كلب حمار خنزير قرد غبي أحمق تافه حقير وقح قذر سافل نذل وغد خسيس منحط جبان متخلف معتوه أبله بهيمة حشرة زبالة كذاب لص حثالة ساقط فاشل بليد جاهل أرعن
دنيء لئيم عديم مقرف قميء تيس بغل جرذ ثور أخرق مغفل مخبول ملعون كلاب حمير خنازير أغبياء حمقى تافهون أوغاد
""".split()
#: Such words that are so only without an article.
BARE_INSULTS = "حيوان حيوانات".split()
#: How somebody is addressed or pointed at.
ADDRESSES = """
you your youre ure u yourself complete total utter absolute whoever anyone nobody mother father writer author tu eres es vous toi ta ton du ihr euch dich espèce
يا أيها أنت أنتم أنتما إنك إنكم لك لكم منك أمك أبوك أبيك كاتب كتب صاحب وجهك عقلك دماغك رأسك مثلك أمثالك تستحق مكانك
""".split()
#: What is done to somebody in a threat, and the word that names the one.
THREATS = """
kill smash break beat murder strangle stab shoot crush slap punch burn rot die choke hang
سأقتلك سأكسر سأحطم سأضربك سأذبحك سأهشم سأدمرك سأحرقك سأخنقك سأقطع سأسحقك اخرس اغرب انقلع اخرسي tuer töten matar
""".split()
THREATENED = "you your yourself face head skull bones teeth ditch hell grave رأسك وجهك عظامك أسنانك يدك عنقك وجهي هنا جهنم الجحيم أمامي".split()
#: What takes the humanity of a group.
DEHUMANISING = """
vermin subhuman cockroach cockroaches parasites rats maggots scum filth filthy dirty rotten animals savages thieves traitors plague disease inferior human blood
حشرات جرذان صراصير قذارة نجس أنجاس كلاب خنازير حثالة لصوص خونة فاسد قذرون البشر متوحشون طاعون وباء أوساخ دمهم
untermenschen ungeziefer vermine sous-hommes humains humanos ratas
""".split()
#: Of these, words that do so wherever they are said of somebody, and how that is said.
VERMIN = "vermin subhuman cockroach cockroaches parasites maggots scum savages untermenschen ungeziefer حشرات جرذان صراصير أنجاس حثالة".split()
SAID_OF = "are is were must هم كلهم إنهم يجب".split()
#: How something is wished.
WISHING = "wish hope ليت أتمنى نتمنى must يجب".split()
#: What is wished to a group.
EXPELLING = """
driven expelled exterminated deported wiped eradicated burned killed die vanish dirty
طردهم إبادتهم يموتون يحترقون تطهير ترحيلهم قتلهم سحقهم يموتوا حرقهم طرد نجس
""".split()
#: How a group is pointed at.
GROUPS = "we us people peoples them they those every tribe race nation all their ours country families neighbours كل جماعة أهل قوم قبيلة طائفة شعب كلهم هؤلاء مثلهم بلادنا بيننا فهم إنهم جميعا أبناء نسل less than أقل من just as".split()
#: Sexually explicit words, and words that are so only in an explicit context.
EXPLICIT = "porn porno pornographic xxx nudes horny blowjob orgasm uncensored hardcore fuck motherfucker إباحية إباحي سكس شهوتي شهوتك نودز عاهرة".split()
BODILY = "sex sexual sexy naked nude undress bed body clips video crave turns جنسي جنسية عاري عارية العاري العارية فراشي فاضح فاضحة ثيابك ثيابي جسمها جسدك جسمك تشتهين أشتهيك أنام".split()
SOLICITING = "come send want tonight hot night anyone do me your with you کبار أريد تعالي أرسلي مقاطع فيديو ساخنة ساخن الليلة يثير معك صورك وأخلع أخلع لكبار بك ما لمن".split()
#: Words around which such words name, teach, heal, play or depict.
NEUTRAL = """
word words means meaning definition dictionary insult insults lesson chapter biology reproduction chromosome chromosomes cells plant plants cancer doctor patient clinic
medical anatomy statue marble painting museum sculpture play actor actress role stage director film novel character circus story poem theatre zoo farm
toy animal animals breed puppy veterinary quote quoted said artificial intelligence device phone charger app battery takes out
كلمة الكلمة شتيمة معنى تعني قاموس درس فصل أحياء تكاثر التكاثر خلايا نبات سرطان طبيب مريض عيادة تمثال رخام لوحة متحف مسرحية المسرحية ممثل دور فيلم رواية الرواية قصة سيرك
حديقة مزرعة لعبة وفي الوحشي البري الصناعي الثدي خطر الشتم السخرية حصان قطة
""".split()

#: Weights of the words alone and of the rules, by name.
WEIGHTS = {"insult": 0.15, "insult_addressed": 1.0, "threat": 0.1, "threat_aimed": 1.0, "dehumanising": 0.1, "vermin": 0.1, "dehumanising_group": 0.8, "expelling_group": 0.8, "explicit": 0.8, "bodily": 0.1, "bodily_soliciting": 0.8}
CATEGORY = {"insult": "abuse", "threat": "abuse", "dehumanising": "hate", "vermin": "hate", "expelling": "hate", "explicit": "sexual", "bodily": "sexual"}
#: Words of a passage, whose weights are summed; words between which two cues belong together; the share that stays near a neutral cue.
PASSAGE, NEAR, NEUTRAL_SHARE = 40, 4, 0.2

DIGITS = str.maketrans("0134578@$!", "oieastbasi")
MARKS = re.compile("[\u0640\u0610-\u061a\u064b-\u0652\u0656-\u065f\u0670]+")
MIXED = re.compile(r"(?<=[a-z*])[0-9@$!]+(?=[a-z*0-9])|(?<![0-9a-z])[0-9@$]+(?=[a-z*])(?=[a-z0-9*]*[a-z]{1})|(?<=[a-z])[0-9@$]+(?![0-9])")
INSIDE = re.compile(r"(?<=[^\W\d_])[.\-_·'’,]+(?=[^\W\d_*])")
SPELLED = re.compile(r"(?<![\w*])(?:[^\W\d_] ){2,}[^\W\d_](?![\w*])")
STARRED = re.compile(r"(?<= )[^ ]*\*[^ ]*(?= )")
BLANK = re.compile(" ")
#: What a text must hold for one of the patterns above to match; each begins with a few characters, which are searched fast.
MAY_BE_MIXED = re.compile(r"[0-9@$!][a-z*0-9]|[0-9@$](?<=[a-z*].)|!(?<=[a-z*].)")
MAY_BE_INSIDE = re.compile(r"[.\-_·'’,][^\W\d_*]")
MAY_BE_SPELLED = re.compile(r" [^\W\d_] [^\W\d_](?![\w*])")


def _spelled(m: re.Match) -> str:
    """Letters spelled one by one as one word; after "a" or "i", which may be words, also without them."""
    word = m.group().replace(" ", "")
    return f"{word} {word[0]} {word[1:]}" if word[0] in "ai" else word


@functools.lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, and whether it is part of a word."""
    letter, word = np.zeros(sys.maxunicode + 1, bool), np.zeros(sys.maxunicode + 1, bool)
    for cp in range(sys.maxunicode + 1):
        ch = chr(cp)
        if ch.isalnum():
            word[cp], letter[cp] = True, not ch.isdecimal()
    word[ord("*")] = True
    return letter, word


def _plain(text: str) -> str:
    t = text.lower()
    if MARKS.search(t):
        t = MARKS.sub("", t)
    if MAY_BE_MIXED.search(t):
        t = MIXED.sub(lambda m: m.group().translate(DIGITS), t)
    if MAY_BE_INSIDE.search(t):
        t = INSIDE.sub("", t)
    return SPELLED.sub(_spelled, t) if MAY_BE_SPELLED.search(t) else t


def fold_all(texts: list[str]) -> list[str]:
    """Folds texts that are already rewritten as they look: words of bare letters between single blanks.

    Digits and signs that stand for letters, marks between letters and letters spelled
    one by one first; then, for the whole batch at once, a letter that repeats goes and
    what is no word is a blank. A star in a word stays: it stands for one letter.
    """
    if not texts:
        return []
    letter, word = _tables()
    padded = [f" {_plain(t)} " for t in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4").copy()
    starts = np.cumsum([0, *map(len, padded[:-1])])
    points[~word[points]] = 32
    again = np.zeros(len(points), bool)
    again[1:] = (points[1:] == points[:-1]) & ((points[1:] == 32) | letter[points[1:]])
    again[starts] = False
    ends = np.cumsum(np.add.reduceat(~again, starts))
    out = points[~again].tobytes().decode("utf-32-le", "surrogatepass")
    return [out[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def fold(text: str) -> str:
    return fold_all([text])[0]


def arabic_forms(word: str) -> list[str]:
    """A word with the usual prefixes and endings of its script; of other scripts as it is, with a plural."""
    if not "\u0621" <= word[0] <= "\u064a":
        return [word, word + "s", word + "es"]
    return [p + word + e for p in ("", "ال", "و", "وال", "ب", "لل", "ف") for e in ("", "ة", "ون", "ين", "ات")]


def lexicon() -> dict[str, set[str]]:
    """The kinds of each folded word."""
    lists = {"insult": INSULTS, "threat": THREATS, "dehumanising": DEHUMANISING, "vermin": VERMIN, "expelling": EXPELLING, "explicit": EXPLICIT, "bodily": BODILY}
    cues = {"address": ADDRESSES, "threatened": THREATENED, "group": GROUPS, "said_of": SAID_OF, "wishing": WISHING, "soliciting": SOLICITING, "neutral": NEUTRAL}
    out: dict[str, set[str]] = {}
    for kind, words in (lists | cues).items():
        for w in words:
            for form in arabic_forms(w) if kind in lists else [w]:
                out.setdefault(fold(as_it_looks(form)).strip(), set()).add(kind)
    for w in BARE_INSULTS:
        out.setdefault(fold(as_it_looks(w)).strip(), set()).add("insult")
    return out


@functools.lru_cache(1)
def known_words() -> dict[str, set[str]]:
    return lexicon()


@functools.lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    """All folded words between blanks, with their lengths and kinds."""
    a = ahocorasick.Automaton()
    for word, of in known_words().items():
        a.add_word(f" {word} ", (len(word) + 2, frozenset(of)))
    a.make_automaton()
    return a


@functools.lru_cache(20_000)
def _starred_kinds(word: str) -> frozenset[str]:
    """The kinds of the words that a word with stars can be: each star is one letter, and half of the letters at least are left."""
    letters = len(word) - word.count("*")
    if letters * 2 < len(word) or letters < 2:
        return frozenset()
    pattern = re.compile("".join("[^ ]" if c == "*" else re.escape(c) for c in word))
    found = set()
    for known, of in known_words().items():
        if len(known) == len(word) and of & set(CATEGORY) and pattern.fullmatch(known):
            found |= of & set(CATEGORY)
    return frozenset(found)


#: What raises a word: its kind, the rule whose weight it gets, the kind of the cue, and the words between them at most.
RAISED = [
    ("insult", "insult_addressed", "address", NEAR), ("threat", "threat_aimed", "threatened", NEAR), ("dehumanising", "dehumanising_group", "group", NEAR),
    ("vermin", "dehumanising_group", "said_of", NEAR), ("expelling", "expelling_group", "group", NEAR), ("expelling", "expelling_group", "wishing", 2 * NEAR),
    ("bodily", "bodily_soliciting", "soliciting", NEAR),
]


def judge(folded: str, weights: dict[str, float] = WEIGHTS) -> tuple[float, float, dict[str, int]]:
    """(the largest weight of a passage, the weight of the whole text, matches by category) of a folded text.

    A word counts with its own small weight, or with a large one if a cue of its kind
    is near. Near a neutral cue, a part of that stays.
    """
    hits = [(end - n + 1, of) for end, (n, of) in automaton().iter(folded)]
    hits += [(m.start() - 1, k) for m in STARRED.finditer(folded) if (k := _starred_kinds(m.group()))]
    if not any(of & CATEGORY.keys() for _, of in hits):
        return 0.0, 0.0, {}
    at = {start: i for i, start in enumerate(m.start() for m in BLANK.finditer(folded))}
    cues: dict[str, list[int]] = {}
    words = sorted((at[start], of) for start, of in hits)
    for i, of in words:
        for kind in of:
            cues.setdefault(kind, []).append(i)

    def near(kind: str, i: int, span: int = NEAR, least: int = 1) -> bool:
        places = cues.get(kind, ())
        around = places[bisect.bisect_left(places, i - span) : bisect.bisect_right(places, i + span)]
        return sum(j != i for j in around) >= least

    fired: list[tuple[int, float]] = []
    counts: dict[str, int] = {}
    for i, of in words:
        weight, kind = max((weights.get(k, 0.0), k) for k in of & CATEGORY.keys()) if of & CATEGORY.keys() else (0.0, "")
        for k, rule, cue, span in RAISED:
            if k in of and weights[rule] > weight and near(cue, i, span):
                weight, kind = weights[rule], k
        if "dehumanising" in of and near("dehumanising", i, least=2):  # three such words point at a group by themselves
            weight, kind = max((weight, kind), (weights["dehumanising_group"], "dehumanising"))
        # A neutral context weakens a word, unless it is said right to somebody or with others of its kind.
        if kind and near("neutral", i) and not (kind == "insult" and near("address", i, 1)) and not (weight >= 0.5 and near(kind, i, 2)):
            weight *= NEUTRAL_SHARE
        if weight:
            fired.append((i, weight))
            counts[CATEGORY[kind]] = counts.get(CATEGORY[kind], 0) + (weight >= 0.5)
    top, total, first, running = 0.0, 0.0, 0, 0.0
    for i, w in fired:
        running += w
        while fired[first][0] <= i - PASSAGE:
            running -= fired[first][1]
            first += 1
        top, total = max(top, running), total + w
    return top, total, counts


SCHEMA = "doc_id long, source string, score double, weight double, abuse int, hate int, sexual int"
#: The least score of a marked document where no labels decide.
LEAST_SCORE = 2.0


def _score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for folded in fold_all(all_as_they_look([t or "" for t in batch.column(2).to_pylist()])):
            top, total, counts = judge(folded)
            rows.append((100.0 * top / PASSAGE, total, *(counts.get(c, 0) for c in ("abuse", "hate", "sexual"))))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        types = [pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]],
            names=["doc_id", "source", "score", "weight", "abuse", "hate", "sexual"],
        )


def scores(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, source, score, weight, abuse, hate, sexual), one for each row of ``documents``.

    score: weight of the worst passage for each hundred of its words, so it depends
    neither on the length of the document nor on where in it the passage is.
    weight: of all matches. Then the number of heavy matches of each category. Null
    and blank texts score 0; copies are scored each.
    """
    return documents.select("doc_id", "source", "text").mapInArrow(_score, SCHEMA)


#: The scores between which the threshold is fitted.
LEAST_FITTED, MOST_FITTED = 1.0, 4.0


def best_threshold(rated: Iterable[tuple[float, bool]], least: float = LEAST_FITTED, most: float = MOST_FITTED) -> float:
    """The score from which on labels and marks agree best (F1), between two limits; of equally good ones the nearest to LEAST_SCORE."""
    rated = list(rated)
    return best_of_counts([(x, 1, int(y)) for x, y in rated], least, most)


def best_of_counts(counts: list[tuple[float, int, int]], least: float = LEAST_FITTED, most: float = MOST_FITTED) -> float:
    """The same from (score, documents, positive ones), which are few at any number of documents."""
    positives = sum(y for _, _, y in counts)
    options = sorted({LEAST_SCORE, *(x for x, _, _ in counts if least <= x <= most)})

    def f1(t: float) -> float:
        marked = [(n, y) for x, n, y in counts if x >= t]
        return 2 * sum(y for _, y in marked) / max(1, sum(n for n, _ in marked) + positives)

    return max(options, key=lambda t: (round(f1(t), 6), -abs(t - LEAST_SCORE)))


def fitted_threshold(documents: DataFrame, labels: DataFrame, least_positive: int = 20) -> float:
    """The threshold fitted on all labelled documents.

    Raters of a document are averaged; null labels are left out. With fewer than
    ``least_positive`` positive ones it is LEAST_SCORE. ``labels`` has doc_id and toxic.
    """
    return _fitted(scores(documents), labels, least_positive)


def _fitted(scored: DataFrame, labels: DataFrame, least_positive: int = 20) -> float:
    rated = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.avg("toxic") >= 0.5).alias("is_toxic"))
    # Labels grow with the documents, so they aren't broadcast. Weights are whole hundredths, so between the limits there are some
    # hundred scores at most (rounded, as sums differ in their last bits); outside of them it only counts on which side a score is.
    score = F.when(F.col("score") < LEAST_FITTED - 1e-9, 0.0).when(F.col("score") > MOST_FITTED + 1e-9, MOST_FITTED + 1).otherwise(F.round("score", 9))
    counts = scored.join(rated.hint("merge"), "doc_id").groupBy(score.alias("score")).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_toxic").alias("positive")).collect()
    if sum(r.positive for r in counts) < least_positive:
        return LEAST_SCORE
    return best_of_counts([(r.score, r.n, r.positive) for r in counts])


def _scored(documents: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, float]:
    """The scores and the threshold. Where it is fitted, the scores are stored, so that each document is scored once."""
    if labels is None:
        return scores(documents), LEAST_SCORE
    scored = stored(scores(documents), "scores")
    return scored, _fitted(scored, labels)


def flagged(documents: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The scores of the documents that reach the threshold, which is fitted if there are labels."""
    scored, least = _scored(documents, labels)
    return scored.where(F.col("score") >= least - 1e-9)


def rates(documents: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Rows (source, docs, flagged, rate, mean_score); a null source has its own row."""
    scored, least = _scored(documents, labels)
    return (
        scored.groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("docs"),
            F.count_if(F.col("score") >= least - 1e-9).alias("flagged"),
            F.avg("score").alias("mean_score"),
        )
        .withColumn("rate", F.col("flagged") / F.col("docs"))
    )
