"""Broken prompt and response pairs.

Language: posteriors of a naive Bayes classifier over character n-grams, of the
prompt and of each response. Truncation: the likelihood that a text ends after its
last words, from n-gram counts over all responses and from the prompt itself (a
correction ends as its prompt ends). Refusals, fillers and copies are matched on
text in its one form (look-alikes rewritten).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasaq.functions.skew import join_unique
from nasaq.llm.formatting import bare
from nasaq.llm.lookalikes import all_as_they_look
from nasaq.session import checkpointed

#: What stands in place of content, without punctuation and in lower case.
FILLERS = {"na", "null", "none", "nil", "nan", "tbd", "todo", "tba", "لايوجد", "لاشيء", "غيرمتوفر", "غيرمتاح", "فارغ", "empty", "blank", "xxx", "undefined", "ninguno", "aucun", "keine"}
#: Phrases by which the writer declines.
REFUSAL = regex.compile(
    r"\b(?:i (?:can ?not|can't|won't|will not|would rather not|am unable|am not able|must decline|have to decline|must refuse|refuse)"
    r"|i'm (?:unable|not able|sorry|afraid)|i am (?:sorry|afraid)|unable to (?:help|correct|answer|comment|edit|assist)|not able to (?:help|correct|answer|comment|edit|assist)"
    r"|not possible for me|my apologies|as an? (?:ai|assistant|language model)"
    r"|je ne peux pas|je suis désolé|no puedo|lo siento|tut mir leid|ich kann (?:\w+ ){0,4}nicht)\b"
    r"|لا أستطيع|لن أستطيع|لن أتمكن|لم أتمكن|لا يمكنني|لن يمكنني|لا يسعني|أعجز عن|عاجز عن|لست قادرا|غير قادر على|أفضل الامتناع|أمتنع عن|أعتذر عن|أعتذر منك|نموذج لغوي"
)
#: Phrases by which an explanation says that the input was right.
WAS_RIGHT = regex.compile(
    r"لا خطأ|لا يوجد خطأ|لا توجد أخطاء|ليس فيها خطأ|ليس فيه خطأ|خالية من الأخطاء|صحيحة كما هي|صحيح كما هو|الجملة صحيحة|الجملة سليمة|التركيب سليم|لم نغير|لا تحتاج إلى تعديل|لا تحتاج إلى تصحيح"
    r"|nothing is wrong|already (?:correct|right)|no (?:change|correction|edit)s? (?:is|are|was|were) (?:needed|necessary|required)|right as written|correct as (?:written|it is|is)"
    r"|no (?:error|mistake)s?\b|sentence is (?:correct|right|fine)"
)
QUOTED = regex.compile("«[^»]*»|\"[^\"]*\"|“[^”]*”|\\([^)]*\\)")
LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+")

#: Conjunctions, prepositions, articles and relative pronouns, which by their grammar ask for another word.
OPENING = """
من إلى في على عن مع و أو ثم أن إن لأن حتى التي الذي الذين كي لكي بسبب إذا عند بين ضمن خلال حول
the a an of to in with and or because that which for at by from as than into while when where if but so our their its
le la les un une des de du et ou à avec pour dans que qui el los las una y o con para en por der die das ein eine und oder mit für von zu im am weil dass
""".split()

LANGUAGES = ("ar", "en", "fr", "es", "de")


class LanguageModel:
    """Naive Bayes over character trigrams, add-one smoothed, equal priors."""

    def __init__(self, texts: dict[str, list[str]]):
        counts = {k: Counter(g for t in ts for g in self.grams(t)) for k, ts in texts.items() if ts}
        vocabulary = {g for c in counts.values() for g in c}
        self.languages = sorted(counts)
        self.logs = {}
        self.unseen = []
        for k in self.languages:
            total = sum(counts[k][g] for g in vocabulary) + len(vocabulary) + 1
            self.unseen.append(-math.log(total))
            for g in vocabulary:
                self.logs.setdefault(g, []).append(math.log((counts[k][g] + 1) / total))

    @staticmethod
    def grams(text: str) -> Iterator[str]:
        t = f" {LETTERS.sub(' ', text.lower()).strip()} "
        return (t[i : i + 3] for i in range(len(t) - 2))

    def posterior(self, text: str) -> dict[str, float]:
        """By language; empty without letters or without a model."""
        sums = [0.0] * len(self.languages)
        n = 0
        for g in self.grams(text):
            if g != "  ":
                n += 1
                for i, x in enumerate(self.logs.get(g, self.unseen)):
                    sums[i] += x
        if not n or not sums:
            return {}
        top = max(sums)
        weights = [math.exp(max(-700.0, s - top)) for s in sums]
        return dict(zip(self.languages, (w / sum(weights) for w in weights), strict=True))


def train_language(documents: DataFrame, per_language: int = 300, seed: int = 7) -> LanguageModel:
    """Fits the classifier on about ``per_language`` whole labelled documents of each language.

    The sample is taken by a hash of doc_id, so it is the same in every run. Wrong
    labels in it only weaken the smoothing.
    """
    rows = documents.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.lower("lang").alias("lang"), "text").where(F.col("lang").isin(*LANGUAGES))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    part = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) / 1_000_000.0
    chosen = F.lit(False)
    for k, n in counts.items():
        chosen = chosen | ((F.col("lang") == k) & (part < min(1.0, per_language / n)))
    texts: dict[str, list[str]] = {}
    for r in rows.where(chosen).orderBy("doc_id").collect():
        texts.setdefault(r.lang, []).append(r.text)
    return LanguageModel(texts)


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def _count_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (a, b, n, e) of the two-word sequences (a, b) and, with a null, of the words b: how often, and how often at an end."""
    total: Counter[tuple[str | None, str]] = Counter()
    ends: Counter[tuple[str | None, str]] = Counter()

    def flush() -> pa.RecordBatch:
        grams = list(total)
        out = pa.RecordBatch.from_pydict(
            {"a": pa.array([g[0] for g in grams], pa.string()), "b": pa.array([g[1] for g in grams], pa.string()), "n": pa.array([total[g] for g in grams], pa.int64()), "e": pa.array([ends[g] for g in grams], pa.int64())}
        )
        total.clear()
        ends.clear()
        return out

    for batch in batches:
        for column in batch.columns:
            for text in all_as_they_look([t or "" for t in column.to_pylist()]):
                words = tokens(text)
                if words:
                    total.update(zip(["", *words], words, strict=False))
                    total.update((None, w) for w in words)
                    ends[(words[-2] if len(words) > 1 else "", words[-1])] += 1
                    ends[None, words[-1]] += 1
        if len(total) > 300_000:
            yield flush()
    yield flush()


def end_likelihoods(responses: DataFrame, seen: int = 20, prior: int = 1000) -> DataFrame:
    """Rows (a, b, e, p) of all ends (last word b after a, or after an empty a) of the text columns: how many texts end so, and the
    likelihood p that a text ends there.

    Counted over all rows, and never on the driver. p backs off from the two words to
    the last one where the two occur ``seen`` times or less; it is 0 if the last word is
    only a part of one that often follows a; null where all is too rare to tell. A word
    that opens a phrase has ``prior`` more occurrences inside texts: some, as a
    conjunction written apart, are so rare that a corpus has them at broken ends only.
    """
    counted = responses.mapInArrow(_count_ends, "a string, b string, n long, e long").groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("e").alias("e"))
    counted = checkpointed(counted.where((F.col("n") > seen) | (F.col("a").isNotNull() & (F.col("e") > 0))))
    two = counted.where("a IS NOT NULL")
    opening = F.col("b").isin(*OPENING)
    one = counted.where("a IS NULL").select("b", (F.col("e") / (F.col("n") + F.when(opening, prior).otherwise(0))).alias("p1"))
    parts = F.transform(F.sequence(F.lit(1), F.length("b") - 1), lambda i: F.substring(F.col("b"), F.lit(1), i))
    begun = two.where((F.col("n") > seen) & (F.length("b") > 1)).select("a", F.explode(parts).alias("b")).distinct().withColumn("begun", F.lit(True))
    p = F.when(F.col("n") > seen, F.col("e") / F.col("n")).when(F.col("begun"), 0.0).otherwise(F.coalesce("p1", F.when(opening, 0.0)))
    return two.where("e > 0").join(begun, ["a", "b"], "left").join(one, "b", "left").select("a", "b", "e", p.alias("p"))


class Judge:
    """Defects of one pair; texts are already in their one form. A truncation that the corpus decides is left open with its end."""

    def __init__(self, language: LanguageModel, doubt: float = 0.01):
        self.language, self.doubt = language, doubt
        #: Posteriors of texts that come again, as explanations without their quotations do.
        self.known: dict[str, dict[str, float]] = {}

    @staticmethod
    def is_empty(text: str | None) -> bool:
        plain = bare(text or "")
        return not plain or plain in FILLERS or not regex.search(r"[\p{L}\p{N}]", plain)

    def other_language(self, own: dict[str, float], response: str) -> bool:
        plain = QUOTED.sub(" ", response)
        plain = plain if TOKEN.search(plain) else response
        theirs = self.known.get(plain)
        if theirs is None:
            theirs = self.language.posterior(plain)
            if len(self.known) < 20_000:
                self.known[plain] = theirs
        if not own or not theirs:
            return False
        mine, best = max(own, key=own.get), max(theirs, key=theirs.get)
        return best != mine and theirs[mine] < self.doubt and theirs[best] > 0.9 and own[mine] > 0.9

    @staticmethod
    def end_in_prompt(prompt: list[str], words: list[str]) -> float | None:
        """The likelihood of the end from the prompt's own n-grams, which outweigh the corpus; None where they don't tell."""
        if not prompt:
            return None
        last = words[-1]
        if prompt[-1] == last:
            return 1.0
        if len(words) > 2 and words[-3:-1] == prompt[-3:-1]:
            return 0.0 if prompt[-1].startswith(last) else 1.0  # the last word itself was corrected
        known = set(prompt)
        if 2 * sum(w in known for w in words) >= len(words) and any(w.startswith(last) for w in prompt[:-1]):
            return 0.0
        return None

    def __call__(self, prompt: str | None, correction: str | None, explanation: str | None) -> set[tuple[str, str | None, str | None]]:
        """(defect, None, None), or ("truncated", a, b) with the last two words if it hangs on their likelihood."""
        out = set()
        own = self.language.posterior(prompt) if prompt else {}
        prompt_words = tokens(prompt or "")
        known = set(prompt_words)
        plain_prompt = bare(prompt or "")
        for field, text in (("correction", correction), ("explanation", explanation)):
            if self.is_empty(text):
                out.add(("empty", None, None))
                continue
            if plain_prompt and bare(text) == plain_prompt:
                if field == "explanation" or not WAS_RIGHT.search((explanation or "").lower()):
                    out.add(("copied", None, None))
                continue
            words = tokens(text)
            # Half of the words outside quotations are the prompt's own: in the prompt's language, and no refusal.
            own_words = tokens(QUOTED.sub(" ", text)) if QUOTED.search(text) else words
            follows = bool(own_words) and 2 * sum(w in known for w in own_words) >= len(own_words)
            if REFUSAL.search(text.lower()) and not follows:
                out.add(("refusal", None, None))
            elif not follows and self.other_language(own, text):
                out.add(("other_language", None, None))
            elif words:
                p = self.end_in_prompt(prompt_words if field == "correction" else [], words)
                if p is None:
                    out.add(("truncated", words[-2] if len(words) > 1 else "", words[-1]))
                elif not p:
                    out.add(("truncated", None, None))
        return out


def defects(pairs: DataFrame, documents: DataFrame, least_end: float = 0.05) -> DataFrame:
    """Rows (item_id, defect), distinct. ``pairs`` has item_id, input, correction, explanation.

    Null, blank or filler responses are ``empty``. Without an input nothing can be
    copied or in another language. An item that arrives again counts once. ``least_end``:
    likelihood of an end under which a text is truncated.
    """
    judge = pairs.sparkSession.sparkContext.broadcast(Judge(train_language(documents)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = judge.value
        for batch in batches:
            ids, found = [], []
            prompts, corrections, explanations = (all_as_they_look([t or "" for t in batch.column(i).to_pylist()]) for i in (1, 2, 3))
            for id_, p, c, e in zip(batch.column(0).to_pylist(), prompts, corrections, explanations, strict=True):
                for defect in of(p, c, e):
                    ids.append(id_)
                    found.append(defect)
            columns = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(list(c), pa.string()) for c in columns)], names=["item_id", "defect", "a", "b"])

    judged = checkpointed(pairs.select("item_id", "input", "correction", "explanation").mapInArrow(run, "item_id long, defect string, a string, b string"))
    # An end that a large part of all texts has is hot, and joined without a shuffle.
    ends = end_likelihoods(pairs.select("correction", "explanation"))
    cut = join_unique(judged.where("b IS NOT NULL"), checkpointed(ends), ["a", "b"], "e").where(F.col("p") < least_end)
    return judged.where("b IS NULL").select("item_id", "defect").unionByName(cut.select("item_id", "defect")).distinct()
