"""Broken prompt and response pairs (problem 5).

Method: texts are sorted (a range partitioning, then a sort inside partitions) and each is compared with its successor by
their common prefix. Three kinds of texts are sorted together or one after the other:

* whole answers: one that another answer to the same request begins with is cut wherever it ends; a beginning of any other
  answer is cut at a length limit, which is a length that answers without a proper end share far more often than the
  lengths beside it;
* last sentences among all sentences of the answers, with digits as 0: one that other sentences begin with, and that
  nowhere else stands as a whole sentence, breaks off, also if it seems to end well ("had a mean of 41.", "(N = 27)").

With these signs, each answer and its request go through the rules: empty, copy, refusal, truncated, language.

A prefix of any other text is a prefix of its successor in the order too, so comparing neighbours finds all of them
without comparing pairs; the last text of a partition is compared with the first of the next by a summary of one row
per partition.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evspark.runtime import checkpoint, lookup_join, table

#: An answer's length is a limit if so many unended answers have it and this many times the mean of the lengths beside.
SPIKE_LEAST, SPIKE_TIMES, SPIKE_NEAR = 5, 8, 5

# ---- the parts of an answer

_FENCE = re.compile(r"^```[\w-]*[ \t]*\n?(.*?)(?:\n?[ \t]*```)?$", re.S)
_TAGS = re.compile(r"</?(?:answer|response|output|result|final|json|text|p|div|br)\s*/?>", re.I)
_NOTHING = {"null", "none", "na", "nan", "nil", "undefined", "empty"}
_EDGES = " \t\r\n\v\f ​‌‍⁠﻿"


def content(raw: str | None) -> str:
    """The answer without its wrapping: fence, tags and outer spaces."""
    text = (raw or "").strip(_EDGES)
    if m := _FENCE.match(text):
        text = m[1].strip(_EDGES)
    return _TAGS.sub("", text).strip(_EDGES)


def parsed(text: str):
    try:
        return json.loads(text)
    except ValueError:
        return None


def _leaves(value):
    if isinstance(value, dict):
        for v in value.values():
            yield from _leaves(v)
    elif isinstance(value, list):
        for v in value:
            yield from _leaves(v)
    else:
        yield value


def says_nothing(value) -> bool:
    if value is None:
        return True
    words = re.sub(r"[\W_]", "", str(value)).lower()
    return not words or words in _NOTHING


def is_empty(text: str) -> bool:
    value = parsed(text)
    if isinstance(value, (dict, list)):
        return all(says_nothing(x) for x in _leaves(value))
    return says_nothing(text)


def spoken(text: str) -> str:
    """The part in the answerer's own words: the rationale of an object, else the text."""
    value = parsed(text)
    if isinstance(value, dict):
        for key in ("rationale", "reason", "explanation", "answer", "response", "text"):
            if isinstance(value.get(key), str):
                return value[key]
        return ""
    return text if value is None else str(value)


# ---- truncated

_SENTENCES = re.compile(r"(?<=[.!?…。])[\"”»')\]]*\s+|\n+")
_ENDED = re.compile(r"[.!?…。»”\"')\]}]\W*$")
#: Lines that may follow the last sentence: a list entry, a code in brackets, a short labelled value.
_CLOSING = re.compile(r"^\s*(?:[-*•]\s+\S.*|\[[^\]]+\]|\W{0,3}[^\W\d_]+(?: \w+)?\W{0,3}:\W{0,3}\s*\S+(?:\s+\S+){0,4}|\([^)]+\))\s*$")


def cut_off(text: str) -> bool:
    """Whether the answer lacks its end: an open object, or words after which a sentence has to go on."""
    if text.startswith(("{", "[")) and parsed(text) is None:
        depth, quoted, skip = 0, False, False
        for c in text:
            if skip:
                skip = False
            elif quoted:
                skip, quoted = c == "\\", c != '"'
            elif c == '"':
                quoted = True
            else:
                depth += (c in "{[") - (c in "}]")
        return quoted or depth > 0
    own = _body(text)
    return len(own) > 0 and not _ENDED.search(own)


def _body(text: str) -> str:
    """What is spoken, without the lines that may follow the last sentence."""
    rows = spoken(text).strip(_EDGES).split("\n")
    while len(rows) > 1 and (not rows[-1].strip() or _CLOSING.match(rows[-1])):
        rows.pop()
    return "\n".join(rows).rstrip(_EDGES)


def sentences(raw: str | None) -> tuple[list[str], str | None]:
    """The sentences of an answer with digits as 0, and the last of them if it's the end of the answer: what a closed object
    says is whole."""
    text = content(raw)
    parts = [re.sub(r"\d+", "0", p) for x in _SENTENCES.split(_body(text)) if (p := x.strip(_EDGES))]
    if not parts or text.startswith(("{", "[")):
        return parts, None
    return parts[:-1], parts[-1]


# ---- refusals: fixed openings in which an answerer declines

REFUSALS = re.compile(
    r"\b(?:"
    r"i (?:can ?not|can[’']t|cannot|won[’']t|will not|must (?:decline|refuse)|have to (?:pass|decline|refuse)|am (?:not able|unable|not allowed|not permitted)|do not feel comfortable|don[’']t feel comfortable|"
    r"(?:would|prefer) (?:rather )?not|decline|refuse)\b(?! to find| find)"
    r"|my (?:guidelines|rules|policy|instructions) (?:do not|don[’']t|forbid|prevent)|(?:not|n[’']t) be appropriate for me|something i (?:won[’']t|can[’']t|cannot|will not)"
    r"|(?:kann|darf|möchte|werde|will) ich\b.{0,60}\bnicht\b|ich (?:kann|darf|möchte|werde|will)\b.{0,60}\bnicht\b"
    r"|je (?:ne (?:peux|puis|souhaite|veux)|préfère ne)\b|il m[’']est impossible|je (?:dois|me vois contrainte? de) (?:décliner|refuser)"
    r"|no (?:puedo|me es posible|podré|debo)\b|prefiero no\b|debo (?:declinar|rechazar)"
    r"|não (?:posso|me é possível|consigo)\b|prefiro não\b|я не могу|не могу (?:помочь|ответить|оценить)|предпочитаю не"
    r")",
    re.I,
)


def is_refusal(text: str) -> bool:
    """Whether at least half of the sentences decline: an answer that declines a part and then answers does not."""
    said = [x for x in _SENTENCES.split(_quoted(spoken(text))) if x.strip(_EDGES)]
    no = sum(REFUSALS.search(x) is not None for x in said)
    return no > 0 and 2 * no >= len(said)


# ---- copies

_ALNUM = re.compile(r"[^\W_]+")
#: Lines of the request count as a copy, and not as a short answer in its words, from so many words on.
LEAST_COPY = 12


def _key(text: str) -> str:
    return " ".join(_ALNUM.findall(text.lower()))


def _told(request: str) -> set[str]:
    """The lines of all strings of a request."""
    value = parsed(request)
    texts = [str(x) for x in _leaves(value) if x is not None] if isinstance(value, (dict, list)) else [request]
    return {_key(row) for x in texts for row in x.split("\n")}


def is_copy(text: str, instructions: str, request: str) -> bool:
    """Whether the answer is the request's, or its own words are: the instructions without as much beside them, most of the
    instructions, or lines of the request only (as a rationale, with the instructions among them)."""
    value = parsed(text)
    if isinstance(value, dict) and isinstance(value.get("instructions"), str):
        return True
    if value is None and re.match(r'\{\s*"instructions"', text.lstrip(_EDGES)):
        return True
    own, asked = _key(spoken(text)), _key(instructions)
    if not own or not request:
        return False
    if asked and asked in own and len(asked) * 2 >= len(own):
        return True
    if own in asked and len(own) * 2 >= len(asked):
        return True
    rows = [k for x in spoken(text).split("\n") if (k := _key(x))]
    if len(own.split()) < LEAST_COPY or (isinstance(value, dict) and rows[0] != asked):
        return False
    low = request.lower()
    if "\\u" not in low and not all(w in low for w in rows[0].split()):
        return False  # a word of the first line stands nowhere in the request
    told = _told(request)
    # the last line may break off
    return all(k in told for k in rows[:-1]) and (rows[-1] in told or (len(rows) > 1 and any(k.startswith(rows[-1]) for k in told)))


# ---- languages

#: Fixed: how instructions name the language of the answer.
ASKED = {
    "en": r"\benglish\b|\banglais\b|\binglés\b|\benglisch\b",
    "fr": r"\bfrench\b|\bfrançais\b|\bfrancés\b|\bfranzösisch\b",
    "es": r"\bspanish\b|\bespañol\b|\bespagnol\b|\bspanisch\b",
    "de": r"\bgerman\b|\bdeutsch\b|\ballemand\b|\balemán\b",
    "pt": r"\bportuguese\b|\bportuguês\b|\bportugais\b|\bportugués\b|\bportugiesisch\b",
    "ru": r"\brussian\b|\bрусском\b|\brusse\b|\bruso\b|\brussisch\b",
    "it": r"\bitalian\b|\bitaliano\b|\bitalien\b|\bitalienisch\b",
}
#: Fixed: frequent function words of each language.
FUNCTION_WORDS = {
    "en": "the of and to in was were is are for with that by from on at because which as not been had has this it its after between into an be or but if there their".split(),
    "fr": "le la les des du de et un une est dans pour par sur que qui au aux été avec ont pas ne plus son sa ses ce cette car après groupe en à".split(),
    "es": "el la los las de del y un una es en para por que con se no al su sus más como lo fue han entre sobre cuando porque según si".split(),
    "de": "der die das den dem des und ein eine einen einer ist in für mit von zu im auf nicht sich es an als bei nach aus wird war weil ob um gegenüber".split(),
    "pt": "o a os as de do da dos das e um uma é em para por que com se não ao no na nos nas mais como foi entre sobre quando pois às".split(),
    "it": "il lo la gli le di del della e un una è in per da che con si non al sul più come sono stato tra".split(),
}
_LANGUAGES = {k: frozenset(v) for k, v in FUNCTION_WORDS.items()}
#: Letters that tell between related languages.
_LETTERS = {"pt": "ãõ", "es": "ñ¿¡", "de": "ß", "fr": "œ"}


def asked_language(instructions: str) -> str | None:
    hits = [k for k, p in ASKED.items() if re.search(p, instructions.lower())]
    return hits[0] if len(hits) == 1 else None


def _quoted(text: str) -> str:
    """Without quoted lines and quotations of several words."""
    text = "\n".join(x for x in text.split("\n") if not x.lstrip().startswith(">"))
    return re.sub(r"[“\"«„][^”\"»“]{15,}[”\"»“]", " ", text).strip()


def language(text: str) -> str | None:
    """The language most function words and letters speak for; None if the text says too little."""
    letters = [c for c in text if c.isalpha()]
    if len(letters) < 12:
        return None
    if sum("а" <= c.lower() <= "я" or c in "ёЁ" for c in letters) * 2 > len(letters):
        return "ru"
    words = re.findall(r"[^\W\d_]+", text.lower())
    score = {k: sum(w in v for w in words) + 2 * sum(c in _LETTERS.get(k, "") for c in text.lower()) for k, v in _LANGUAGES.items()}
    best = max(score, key=lambda k: score[k])
    rest = max(v for k, v in score.items() if k != best)
    return best if score[best] >= 2 and score[best] > rest else None


def wrong_language(text: str, instructions: str) -> bool:
    asked = asked_language(instructions)
    if asked is None:
        return False
    rows = [x for x in _quoted(spoken(text)).split("\n") if not _CLOSING.match(x)]
    found = language(" ".join(rows))
    return found is not None and found != asked


# ---- the operator


def defect_of(raw: str | None, request: str | None, cut: bool) -> str | None:
    text = content(raw)
    if is_empty(text):
        return "empty"
    asked = parsed(request or "")
    instructions = asked.get("instructions") if isinstance(asked, dict) else None
    instructions = instructions if isinstance(instructions, str) else ""
    if is_copy(text, instructions, request or ""):
        return "copy"
    if is_refusal(text):
        return "refusal"
    if cut or cut_off(text):
        return "truncated"
    return "language" if wrong_language(text, instructions) else None


def _neighbours(batches):
    """(raw_text, shortened) of sorted texts, and one row with the first and last text: the last one waits for the
    next partition."""
    before, first = None, None
    for pdf in batches:
        out = []
        for text in pdf["raw_text"]:
            first = text if first is None else first
            if before is not None:
                out.append((before, text.startswith(before), None))
            before = text
        yield pd.DataFrame(out, columns=["raw_text", "shortened", "first"]).astype({"shortened": "boolean"})
    if before is not None:
        yield pd.DataFrame([(before, None, first)], columns=["raw_text", "shortened", "first"]).astype({"shortened": "boolean"})


def shortened_versions(texts: DataFrame) -> DataFrame:
    """(raw_text): of distinct texts (raw_text) those that another one begins with."""
    rows = (
        texts.select("raw_text").repartitionByRange(F.col("raw_text")).sortWithinPartitions("raw_text")
        .mapInPandas(_neighbours, "raw_text string, shortened boolean, first string").withColumn("part", F.spark_partition_id())
    )
    rows = checkpoint(rows)  # ranges are drawn from a sample: they have to be the same for ends and rest
    ends = rows.where("first IS NOT NULL")  # one row per partition
    following = ends.withColumn("next", F.lead("first").over(Window.orderBy("part"))).select("part", "next")
    last = ends.join(F.broadcast(following), "part").where(F.col("next").startswith(F.col("raw_text")))
    return rows.where("shortened").select("raw_text").unionByName(last.select("raw_text"))


def cut_attempts(answers: DataFrame) -> DataFrame:
    """(request_id, text) of answers that another answer to the same request begins with."""
    texts = answers.where("request_id IS NOT NULL AND trim(raw_text) <> ''").select("request_id", "text", "raw_text").distinct()
    following = F.lead("raw_text").over(Window.partitionBy("request_id").orderBy("raw_text"))
    return texts.withColumn("next", following).where(F.col("next").startswith(F.col("raw_text"))).select("request_id", "text")


def _ends(batches):
    """(sentence, whole, text): each sentence of a text, and of the last one which text it ends if it ends one."""
    for pdf in batches:
        rows = []
        for key, raw in zip(pdf["text"], pdf["raw_text"], strict=True):
            inner, last = sentences(raw)
            rows += [(x, None) for x in inner]
            if last is not None:
                rows.append((last, key))
        yield pd.DataFrame(rows, columns=["sentence", "text"], dtype="object")


def broken_ends(texts: DataFrame) -> DataFrame:
    """(text): of distinct texts (text, raw_text) those whose last sentence others begin with, and which is whole nowhere.

    A sentence is whole where another one follows it, or a closed object does.
    """
    rows = checkpoint(texts.select("text", "raw_text").mapInPandas(_ends, "sentence string, text string"))
    each = rows.groupBy("sentence").agg(F.count_if(F.col("text").isNull()).alias("whole"))
    begun = shortened_versions(each.select(F.col("sentence").alias("raw_text"))).select(F.col("raw_text").alias("sentence"))
    broken = checkpoint(each.where("whole = 0").join(begun, "sentence", "left_semi").select("sentence"))
    # two bare shuffles: a hot sentence is split
    return rows.where("text IS NOT NULL").join(broken, "sentence").select("text").distinct()


def length_limits(answers: DataFrame) -> DataFrame:
    """(size): lengths at which answers are cut, from those that do not end as a text ends and are not empty."""
    words = F.lower(F.regexp_replace(F.regexp_replace("raw_text", r"</?[A-Za-z]+\s*/?>|```\w*", ""), r"[^\p{L}\p{N}]", ""))
    unended = answers.where((words != "") & ~words.isin(*sorted(_NOTHING))).where(~F.col("raw_text").rlike(r"[.!?}`\]\"]\s*$")).groupBy(F.length("raw_text").alias("size")).agg(F.count("*").alias("n"))
    near = F.explode(F.sequence(F.col("size") - SPIKE_NEAR, F.col("size") + SPIKE_NEAR)).alias("size")
    around = unended.select(near, "n").groupBy("size").agg(F.sum("n").alias("all"))
    mean = (F.col("all") - F.col("n")) / (2 * SPIKE_NEAR)
    return unended.join(around, "size").where((F.col("n") >= SPIKE_LEAST) & (F.col("n") > SPIKE_TIMES * mean)).select("size")


def defects(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """(request_id, attempt, defect) of each defective answer of the kind response, however the kind is typed.

    An answer has one defect, the first that applies of empty, copy, refusal, truncated and language. A NULL text is
    empty. Equal second rows count once; different texts under one attempt are looked at each. An answer without a
    request is held against no instructions.
    """
    kind = F.regexp_replace(F.lower("kind"), r"[\W_]", "") == "response"
    answers = responses.where(kind).select(
        "request_id", F.col("attempt").cast("long").alias("attempt"), F.coalesce("raw_text", F.lit("")).alias("raw_text")
    ).distinct()
    answers = checkpoint(answers.withColumn("text", F.md5("raw_text")))
    limits = checkpoint(length_limits(answers))
    # the same text may be the answer to any part of the requests: texts are compared once, and joined by how hot they are
    texts = checkpoint(answers.where("trim(raw_text) <> ''").groupBy("text").agg(F.count("*").alias("n"), F.min("raw_text").alias("raw_text")))
    at_limit = shortened_versions(texts.select("raw_text")).withColumn("size", F.length("raw_text")).join(limits, "size", "left_semi")
    cut = checkpoint(at_limit.select(F.md5("raw_text").alias("text")).unionByName(broken_ends(texts)).distinct().withColumn("cut", F.lit(True)))
    marked = lookup_join(answers, cut, "text", texts.select("text", "n"))
    marked = marked.join(cut_attempts(answers).withColumn("again", F.lit(True)), ["request_id", "text"], "left")
    asked = requests.groupBy("request_id").agg(F.min("request").alias("request"))

    def judge(batches):
        for pdf in batches:
            pdf["defect"] = [
                defect_of(t, r, c is True or a is True) for t, r, c, a in zip(pdf["raw_text"], pdf["request"], pdf["cut"], pdf["again"], strict=True)
            ]
            yield pdf.loc[pdf["defect"].notna(), ["request_id", "attempt", "defect"]]

    return (
        marked.select("request_id", "attempt", "raw_text", "cut", "again").join(asked, "request_id", "left")
        .mapInPandas(judge, "request_id string, attempt long, defect string").distinct()
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects(table(spark, sf_dir, "responses"), table(spark, sf_dir, "requests"))


def p5_defect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_found(spark, sf_dir).groupBy("defect").agg(F.count("*").alias("n_answers"))
