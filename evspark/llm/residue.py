"""Template residue and error-page text (problem 10).

Method: a labelled set of lines of residue (LABELLED, or the caller's own) is put beside the lines of all texts. Every line
gets a SimHash of its five-word shingles; partitioned tables find lines at a small Hamming distance, and the least hashes
of the shingles find all other lines of similarity SIMILARITY: the texts are then compared. The label of the labelled lines
spreads over the connected components of near-duplicate lines. A text is residue if one of its lines is reached. Filler
text is random words of a fixed vocabulary, so no line of it is like another: such lines are labelled by their vocabulary.

The 64 bits are cut into five blocks, and each pair of blocks is the key of a table: two hashes that differ in up to HAMMING
bits agree in two blocks at least. Of two sets with the wanted similarity, either has one of its floor(n / 5) + 1 least
elements among those of the other. The tables alone miss nearly all pairs that are just similar enough; this join, which
goes out from labelled lines only, misses none.

An unfilled field makes a text residue wherever it stands, but its label does not spread: the line around a field is
content, and the same line with the field filled in is sound.

Only numbers leave the Python workers: (doc_id, key, SimHash, label, hashes). Lines of equal words, whatever their punctuation
and digits, have one key and are one node of the graph however often they occur, so boilerplate that stands in a third
of all texts is one row in the tables; a label of any of them is a label of all. Texts are fetched again only for
candidates beside a labelled line.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evspark.runtime import checkpoint, table

SHINGLE, SIMILARITY, HAMMING = 5, 0.8, 3
#: Blocks of bits (first bit, number), two of which make the key of a table.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
TABLES = tuple(itertools.combinations(range(len(BLOCKS)), 2))

NONE, FIELD, WHOLE = 0, 1, 2

# ---- unfilled fields

_NAME = r"[^\W\d_][\w \-/.#]*?"
#: Notations of a field nobody filled in, each with a string without which there is none.
FIELDS = [
    ("{{", rf"\{{\{{\s*#?{_NAME}\s*\}}\}}"),
    ("${", rf"\$\{{\s*{_NAME}\s*\}}"),
    ("{%", r"\{%\s*[^%{}\n]+\s*%\}"),
    ("[[", rf"\[\[\s*{_NAME}\s*\]\]"),
    ("<<", rf"<<\s*{_NAME}\s*>>"),
    ("«", r"«\s*[^\W\d_][\w\-/.#]*(?: [\w\-/.#]+)?\s*»(?!\w)"),  # three words and more are a quotation
    ("@@", rf"@@\s*{_NAME}\s*@@"),
    ("%", r"%(?<!\w%)[A-Z][A-Z0-9_]+%(?!\w)"),
    ("__", r"__(?<!\w__)[A-Z][A-Z0-9_]*?__(?!\w)"),
    ("#", r"#(?<!\w#)[A-Z][A-Z0-9_]+#(?!\w)"),
    ("[", r"\[\s*(?:INSERT|Insert|insert|ENTER|Enter|enter|ADD|Add|add|FILL IN|Fill in|fill in|YOUR|Your|your)\b[^\[\]\n]+\]"),
    ("[", r"\[[^\[\]\n]+\s(?:to be (?:added|completed|confirmed|filled in|inserted)|goes here|TO BE ADDED|TBD|TBC)\]"),
    ("____", rf"____+\s*[\[(]\s*{_NAME}\s*[\])]"),
    ("……", rf"……+\s*[\[(]\s*{_NAME}\s*[\])]"),
    ("......", rf"\.\.\.\.\.\.+\s*[\[(]\s*{_NAME}\s*[\])]"),
    ("TB", rf"TB(?<!\wTB)[DAC]\s*[\[(]\s*{_NAME}\s*[\])]"),
    ("TODO", r"TODO(?<!\wTODO)\s*:\s*\S+"),
    ("FIXME", r"FIXME(?<!\wFIXME)\s*:\s*\S+"),
    ("X.X", r"X\.X{1,3}\s*\(\s*(?:SD|SE|CI|M|N)\b[^)\n]*X"),
    ("<", r"<(?<!<<)(?P<tag>[A-Za-z][\w \-]*)>(?!>)"),
]
_FIELDS = [(sign, re.compile(pattern)) for sign, pattern in FIELDS]
#: Names in angle brackets that are markup; others are too if the text closes them.
MARKUP = frozenset(
    "a abbr b big blockquote br center cite code dd del dfn div dl dt em font h1 h2 h3 h4 h5 h6 hr html i img ins kbd li noscript ol p pre q s script small "
    "span strong style sub sup table tbody td tfoot th thead tr tt u ul var".split()
)
#: A field that the text speaks of: named as one, or in quotation marks.
_SPOKEN_OF = re.compile(
    r"(?:template|merge|form|placeholder|blank|empty)\s+(?:fields?|markers?|tokens?|variables?)\W{0,4}$"
    r"|\bplaceholders?(?:\s+\w+){0,4}\W{0,4}$|\bof\s+the\s+form\W{0,4}$|\b(?:braces|brackets|marker|notation|string)\W{0,4}$"
    r"|[“\"‘'`„]\s*$",
    re.I,
)


def has_field(text: str) -> bool:
    for sign, pattern in _FIELDS:
        if sign in text:
            for m in pattern.finditer(text):
                tag = m.groupdict().get("tag")
                if tag and (tag.lower() in MARKUP or f"</{tag}" in text):
                    continue
                if not _SPOKEN_OF.search(text[max(0, m.start() - 60) : m.start()]):
                    return True
    return False


# ---- lines that are residue as a whole

#: Fixed vocabularies of filler text.
LATIN_FILLER = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad "
    "minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit "
    "esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
TYPED_FILLER = frozenset("blah foo bar baz qux test testing xxx asdf asdfasdf qwer qwerty qwertz asd lkj jkl hjkl zxcv abc aaa bla yadda dummy text sample".split())

#: Labelled lines: notices as sites, servers and programs show them. Alternatives stand in braces. Digits count as 0.
LABELLED = [
    "Please {enable|activate|allow|turn on} {JavaScript|scripts|cookies|JavaScript and cookies} to {view|read|see|continue to} this {article|page|document|site|content}.",
    "You {need|have} to {enable|activate} {JavaScript|scripts|cookies|JavaScript and cookies} to {view this page|view this site|run this app|continue to the full text}.",
    "{This|The} {site|page|website} {requires|needs} {JavaScript|scripts|cookies} to be {enabled|switched on} in your browser. Reload after changing the setting.",
    "Your browser does not support {JavaScript|scripts}, so the {reader|page|viewer} cannot be displayed.",
    "{JavaScript is|Scripts are} {disabled|blocked|switched off} in your browser.",
    "To use the {document viewer|reader|site}, turn on {scripting|JavaScript}.",
    "<noscript>To use the {document viewer|reader|site}, turn on {scripting|JavaScript}.</noscript>",
    "Viewer inactive: allow scripts, then press refresh (notice 0).",
    "Loading… If nothing appears, {scripting|JavaScript} may be {blocked by an extension|disabled}.",
    "Checking your browser before {granting access|accessing the site}. {Scripts|Cookies} must be allowed for this check.",
    "{Bitte aktivieren Sie|Aktivieren Sie bitte} {JavaScript|Skripte|Cookies}, um {den Volltext|diese Seite|den Artikel} anzuzeigen.",
    "Veuillez activer {JavaScript|les scripts|les cookies} pour {afficher|lire|voir} {cette page|cet article|ce document}.",
    "{Active|Habilite} JavaScript en su navegador para {leer|ver} este {documento|artículo|sitio}.",
    "{Ative|Habilite} o JavaScript no seu navegador para {ler|ver} este {documento|artigo|site}.",
    "Пожалуйста, включите JavaScript, чтобы {прочитать эту статью|открыть эту страницу}.",
    "0 – page not found. The {address|page} you {asked for|requested} does not exist on this server.",
    "{Sorry, the page|The page} you {are looking for|requested} {could not be found|does not exist}.",
    "{Sorry, page|Page|File|Article|Error 0: page} not found.",
    "{HTTP/0.0 |Error |}0 {Forbidden|Not Found|Bad Gateway|Bad Request|Unauthorized|Internal Server Error|Service Unavailable|Gateway Timeout|Too Many Requests}",
    "Error 0: the service is temporarily unavailable. Please try again {in a few minutes|later}.",
    "The {service|site|server} is temporarily {unavailable|down}.",
    "Internal server error. The request could not be completed; reference 0.",
    "The requested {article|page|document} could not be {retrieved|found}. Gateway timeout (0).",
    "We are down for {scheduled maintenance|maintenance|repairs}. The {archive|site|service} returns shortly.",
    "Oops! Something went wrong while loading this page. Our team has been notified.",
    "{Your|The} session has expired. Please log in again to continue.",
    "{Access denied. |}You don't have permission to {view this full text|view this page|access this resource} (code 0).",
    "Too many requests. Your {IP address|address} has been blocked for 0 {seconds|minutes}.",
    "Erreur 0 : une erreur interne est survenue {pendant|lors de|durant} le traitement.",
    "{Page|Article} {introuvable|non trouvée|non trouvé}.",
    "Seite nicht gefunden. Der angeforderte Inhalt ist nicht mehr verfügbar (Fehler 0).",
    "Página no encontrada. Vuelva al inicio o utilice el buscador. Código 0.",
    "Página não encontrada. Volte ao início ou use a busca. Código 0.",
    "Страница не найдена. Вернитесь на главную.",
    'Traceback (most recent call last): File "{export|main|app|index|server|run|views}.py", line 0, in {render|main|run|load|get|export|module}',
    "{Key|Value|Type|Name|Index|Attribute}Error: '{abstract|title|text|id|body|content}'",
    "PDF conversion failed: no text layer (job 0).",
    "Your text goes here. Replace this paragraph. Sample abstract text.{| Your text goes here. Replace this paragraph. Sample abstract text.}",
    "{Your|Sample|Dummy|Placeholder} text {goes here|here}.",
    "{Replace this|Add your|Insert your|Type your} {paragraph|text|abstract} here.",
]
_ALTERNATIVES = re.compile(r"\{([^{}]*)\}")
_FILLER = LATIN_FILLER | TYPED_FILLER
_TOKEN = re.compile(r"[^\W_]+|\n")
_WORD = re.compile(r"[^\W_]+")


def expanded(template: str) -> list[str]:
    """All lines that a template with alternatives stands for."""
    parts = [p.split("|") if i % 2 else [p] for i, p in enumerate(_ALTERNATIVES.split(template))]
    return ["".join(x) for x in itertools.product(*parts)]


def is_filler(words: list[str]) -> bool:
    """Four words at least, seven tenths of them of one vocabulary."""
    enough = 0.7 * len(words)
    if len(words) < 4 or sum(map(_FILLER.__contains__, words)) < enough:
        return False
    return any(sum(map(known.__contains__, words)) >= enough for known in (LATIN_FILLER, TYPED_FILLER))


# ---- SimHash

_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


class _Codes(dict):
    """Hashes of words, digits as 0; a line break is 0."""

    def __missing__(self, word: str) -> int:
        code = 0 if word == "\n" else xxhash.xxh3_64_intdigest(re.sub(r"\d+", "0", word)) | 1
        if len(self) > 400_000:
            self.clear()
        self[word] = code
        return code


def shingle_hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first position of each line of a string of word codes, where 0 ends a line; the hashes of all shingles, and
    where those of each line begin.

    A line shorter than a shingle is one shingle.
    """
    text = np.concatenate((codes, np.zeros(SHINGLE, dtype=np.uint64)))
    n = len(codes)
    live = codes != 0
    line = np.cumsum(text == 0)[: n + SHINGLE]
    first = live & np.concatenate(([True], ~live[:-1])) if n else live
    mixed = np.zeros(n, dtype=np.uint64)
    whole = np.zeros(n, dtype=bool)
    for k in range(SHINGLE):
        same = line[k : k + n] == line[:n]
        mixed += np.where(same, text[k : k + n], np.uint64(0)) * _PRIMES[k]
        whole = same
    keep = live & (whole | first)
    h = mixed[keep]
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return np.flatnonzero(first), h, np.flatnonzero(first[keep])


def least_hashes(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of least hashes that each line is found by, and these hashes, line by line."""
    ends = np.append(at[1:], len(h))
    sizes, values, begin = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)], 0
    while begin < len(at):  # whole lines, so few at a time that their numbers fit above 40 bits of hash
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + 50_000)))
        own = np.repeat(np.arange(end - begin, dtype=np.uint64), ends[begin:end] - at[begin:end])
        sets = np.unique(own << np.uint64(40) | h[at[begin] : ends[end - 1]] >> np.uint64(24))
        n = np.bincount((sets >> np.uint64(40)).astype(np.int64), minlength=end - begin)
        some = np.floor((1 - SIMILARITY) * n + 1e-9).astype(np.int64) + 1
        place = np.arange(len(sets)) - np.repeat(np.cumsum(n) - n, n)
        sizes.append(some)
        values.append((sets[place < np.repeat(some, n)] & np.uint64((1 << 40) - 1)).astype(np.int64))
        begin = end
    return np.concatenate(sizes), np.concatenate(values)


def simhashes_of(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    if not len(at):
        return np.empty(0, dtype=np.int64)
    counts = np.diff(np.concatenate((at, [len(h)])))
    out = np.empty((len(at), 64), dtype=bool)
    step = 50_000
    begin = 0
    while begin < len(at):  # whole lines, some fifty thousand shingles at a time
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + step)))
        stop = at[end] if end < len(at) else len(h)
        bits = np.unpackbits(h[at[begin] : stop].view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.add.reduceat(bits, at[begin:end] - at[begin], axis=0, dtype=np.int32)
        out[begin:end] = sums * 2 > counts[begin:end, None]
        begin = end
    return np.packbits(out, axis=1).view(np.int64).ravel()


def line_keys(codes: np.ndarray) -> np.ndarray:
    """A hash of the words of each line of a string of word codes, in the order of ``simhashes``."""
    live = codes != 0
    first = np.flatnonzero(live & np.concatenate(([True], ~live[:-1]))) if len(codes) else np.empty(0, dtype=np.int64)
    if not len(first):
        return np.empty(0, dtype=np.int64)
    begin = np.zeros(len(codes), dtype=np.int64)
    begin[first] = first
    place = np.arange(len(codes)) - np.maximum.accumulate(begin)
    h = codes + place.astype(np.uint64) * _PRIMES[0]
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return np.add.reduceat(np.where(live, h, np.uint64(0)), first).view(np.int64)


_OUT = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("sim", pa.int64()), ("label", pa.int8()), ("least", pa.list_(pa.int64()))])


class _Stream:
    """The words of some texts as one string of codes, where 0 ends a line and every text."""

    def __init__(self, codes: _Codes):
        self.codes, self.values = codes, []

    def add(self, text: str) -> list[int]:
        """Add a text; returns where its lines of filler begin."""
        tokens = _TOKEN.findall(text.lower())
        begin, base, filler = 0, len(self.values), []
        for end in [*(i for i, t in enumerate(tokens) if t == "\n"), len(tokens)]:
            if end > begin and is_filler(tokens[begin:end]):
                filler.append(base + begin)
            begin = end + 1
        codes = self.codes
        self.values.extend([codes[t] for t in tokens])
        self.values.append(0)
        return filler

    def hashed(self) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray, np.ndarray]:
        """Of each line with words its first place, key, SimHash, number of least hashes; and these hashes."""
        codes = np.array(self.values, dtype=np.uint64)
        first, h, at = shingle_hashes(codes)
        return first, line_keys(codes).tolist(), simhashes_of(h, at), *least_hashes(h, at)


def _lines(batches):
    codes = _Codes()
    seen: set[int] = set()  # a line's hashes leave a task once, or a few times
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for begin in range(0, len(ids), 64):
            docs, keys, sims, labels = [], [], [], []
            stream = _Stream(codes)
            where: list[tuple[int, int]] = []  # where each text begins in the stream
            filler: set[int] = set()
            for d, text in zip(ids[begin : begin + 64], texts[begin : begin + 64], strict=True):
                if not text:
                    continue
                text = unicodedata.normalize("NFC", text)
                if has_field(text):
                    docs.append(d)
                    keys.append(None)
                    sims.append(None)
                    labels.append(FIELD)
                where.append((len(stream.values), d))
                filler.update(stream.add(text))
            first, own_keys, sim, sizes, least = stream.hashed()
            new = np.zeros(len(sizes), dtype=bool)
            for i, key in enumerate(own_keys):
                if key not in seen:
                    seen.add(key)
                    new[i] = True
            if len(seen) > 400_000:
                seen.clear()
            sizes_out = np.concatenate((np.zeros(len(keys), dtype=np.int64), np.where(new, sizes, 0)))
            offsets = np.concatenate(([0], np.cumsum(sizes_out))).astype(np.int32)
            hashes = pa.ListArray.from_arrays(pa.array(offsets), pa.array(least[np.repeat(new, sizes)], pa.int64()))
            keys += own_keys
            starts, owners = np.array([w for w, _ in where]), [d for _, d in where]
            for p, x, k in zip(first.tolist(), sim.tolist(), np.searchsorted(starts, first, "right").tolist() if where else [], strict=True):
                docs.append(owners[k - 1])
                sims.append(x)
                labels.append(WHOLE if p in filler else NONE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(keys, pa.int64()), pa.array(sims, pa.int64()), pa.array(labels, pa.int8()), hashes], schema=_OUT
            )


_SCHEMA = "doc_id long, key long, sim long, label byte, least array<long>"


@lru_cache(maxsize=4)
def _labelled(templates: tuple[str, ...]) -> tuple[list[tuple], list[tuple[int, str]]]:
    """Rows as ``lines`` has them, without a document, and (key, line), of the labelled lines."""
    rows, texts, codes = [], [], _Codes()
    for line in dict.fromkeys(x for t in templates for x in expanded(t)):
        stream = _Stream(codes)
        stream.add(unicodedata.normalize("NFC", line))
        first, keys, sim, _, least = stream.hashed()
        if len(keys) != 1:
            raise ValueError(f"a labelled line is one line with words: {line!r}")
        rows.append((None, keys[0], int(sim[0]), WHOLE, least.tolist()))
        texts.append((keys[0], line))
    return rows, texts


def lines(documents: DataFrame) -> DataFrame:
    """(doc_id, key, sim, label, least) of every line with words; of a text with an unfilled field also a row without
    ``key``. At least one row of each key has the hashes it is found by."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_lines, _SCHEMA)


#: Rows up to which one side of a join is broadcast, some megabytes; larger ones are shuffled.
SMALL = 100_000


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= SMALL else df


def _tables(df: DataFrame) -> DataFrame:
    """(t, place, sim, and the other columns), ten rows a line: its places in the tables."""
    block = lambda b: F.shiftrightunsigned(F.col("sim"), BLOCKS[b][0]).bitwiseAND((1 << BLOCKS[b][1]) - 1)
    places = [
        F.struct(F.lit(t).cast("byte").alias("t"), F.shiftleft(block(i), 13).bitwiseOR(block(j)).alias("place")) for t, (i, j) in enumerate(TABLES)
    ]
    return df.select("*", F.explode(F.array(*places)).alias("x")).select(*df.columns, "x.t", "x.place")


def near_duplicates(reached: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(u, v): of ``n`` lines (key, sim) and all lines, pairs of keys that share a place in a table and differ in HAMMING bits at
    most."""
    a = _tables(reached.select(F.col("key").alias("u"), "sim")).withColumnRenamed("sim", "other")
    b = _tables(nodes.select(F.col("key").alias("v"), "sim"))
    near = F.bit_count(F.col("sim").bitwiseXOR(F.col("other"))) <= HAMMING
    return b.join(_small(a, n * len(TABLES)), ["t", "place"]).where((F.col("u") != F.col("v")) & near).select("u", "v")


def sharing(reached: DataFrame, hashed: DataFrame, n: int) -> DataFrame:
    """(u, v): of ``n`` lines and all lines, pairs of keys that have one of their least hashes in common, and numbers of
    shingles with which they can be similar enough."""
    size = F.size("least")
    # the least and the greatest number of shingles a line with so many hashes can have
    fewest, most = F.ceil((size - 1) / (1 - SIMILARITY) - 1e-6), F.ceil(size / (1 - SIMILARITY) - 1e-6) - 1
    every = hashed.select("key", fewest.alias("fewest"), most.alias("most"), "least")
    own = every.join(_small(reached.select("key"), n), "key", "left_semi").select(
        F.col("key").alias("u"), F.explode("least").alias("hash"), F.col("fewest").alias("a"), F.col("most").alias("b")
    )
    own = checkpoint(own.distinct())
    other = every.select(F.col("key").alias("v"), "fewest", "most", F.explode("least").alias("hash"))
    close = (F.col("most") >= SIMILARITY * F.col("a") - 1e-6) & (F.col("b") >= SIMILARITY * F.col("fewest") - 1e-6)
    return other.join(_small(own, own.count()), "hash").where(close & (F.col("u") != F.col("v"))).select("u", "v")


def shingles(line: str) -> frozenset:
    words = [re.sub(r"\d+", "0", w) for w in _WORD.findall(line.lower())]
    return frozenset(tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1)))


def _texts(batches):
    """(key, line) of the lines of whole texts."""
    codes = _Codes()
    for batch in batches:
        keys, rows = [], []
        for text in batch.column(0).to_pylist():
            text = unicodedata.normalize("NFC", text or "")
            stream = np.array([codes[t] for t in _TOKEN.findall(text.lower())], dtype=np.uint64)
            own = [row for row in text.split("\n") if _WORD.search(row)]
            keys += line_keys(stream).tolist()
            rows += own
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(rows, pa.string())], ["key", "line"])


def _similar(batches):
    for batch in batches:
        x, y = (batch.column(i).to_pylist() for i in (2, 3))
        ok = []
        for a, b in zip(x, y, strict=True):
            p, q = shingles(a), shingles(b)
            ok.append(len(p & q) >= SIMILARITY * len(p | q))
        yield batch.filter(pa.array(ok, pa.bool_())).select([0, 1])


def spread(documents: DataFrame, rows: DataFrame, nodes: DataFrame, known_texts: DataFrame) -> DataFrame:
    """(key) of the labelled lines and of all that are linked to one by verified near-duplicates.

    Goes out from the labelled lines: in each round the candidates beside the lines reached last have their texts
    fetched and compared by shingles, until no line is new. ``nodes`` has (key, sim, label), ``known_texts`` (key, line) of
    lines that stand in no document. The lines reached in a round are broadcast if they are few, else shuffled.
    """
    reached = checkpoint(nodes.where(F.col("label") == WHOLE).select("key", "sim"))
    known, n = reached.select("key"), reached.count()
    total, hashed = n, rows.where(F.size("least") > 0).select("key", "least")
    while n:
        found = near_duplicates(reached, nodes, n).unionByName(sharing(reached, hashed, n)).distinct()
        pairs = checkpoint(found.join(_small(known.select(F.col("key").alias("v")), total), "v", "left_anti").select("u", "v"))
        many = pairs.count()
        if not many:
            break
        doubtful = pairs.select(F.explode(F.array("u", "v")).alias("key")).distinct()
        ids = rows.join(_small(doubtful, 2 * many), "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
        texts = (
            documents.join(_small(ids, 2 * many), "doc_id", "left_semi").select("text").mapInArrow(_texts, "key long, line string").unionByName(known_texts)
            .join(_small(doubtful, 2 * many), "key", "left_semi").groupBy("key").agg(F.min("line").alias("line"))
        )
        texts = checkpoint(texts)
        named = lambda c, texts=texts: texts.select(F.col("key").alias(c), F.col("line").alias(c + "_line"))
        compared = pairs.join(named("u"), "u").join(named("v"), "v").select("u", "v", "u_line", "v_line")
        new = checkpoint(compared.mapInArrow(_similar, "u long, v long").select(F.col("v").alias("key")).distinct())
        reached = checkpoint(nodes.select("key", "sim").join(_small(new, new.count()), "key", "left_semi"))
        n = reached.count()
        known, total = known.unionByName(reached.select("key")), total + n
    return known


def residue(documents: DataFrame, labelled: tuple[str, ...] = tuple(LABELLED)) -> DataFrame:
    """(doc_id, n_fields, n_lines): texts with residue, whether they have an unfilled field (1 or 0), and the number
    of their lines that are residue as a whole.

    ``documents`` has (doc_id, text). ``labelled`` are lines known to be residue, with alternatives in braces. Null and
    empty texts, and texts without a word, have no residue; rows with the same doc_id count as one text. Other columns are
    ignored.
    """
    spark = documents.sparkSession
    told, texts = _labelled(tuple(labelled))
    rows = checkpoint(lines(documents).unionByName(spark.createDataFrame(told, _SCHEMA)))
    nodes = rows.where("key IS NOT NULL").groupBy("key", "sim").agg(F.max("label").alias("label"))
    known = checkpoint(spread(documents, rows, checkpoint(nodes), spark.createDataFrame(texts, "key long, line string")))
    linked = rows.where("doc_id IS NOT NULL").select("doc_id", "key").join(_small(known, known.count()), "key", "left_semi").select("doc_id", F.lit(WHOLE).cast("byte").alias("label"))
    found = rows.where(F.col("label") == FIELD).select("doc_id", "label").unionByName(linked)
    return found.groupBy("doc_id").agg(
        F.max((F.col("label") == FIELD).cast("int")).alias("n_fields"), F.count_if(F.col("label") == WHOLE).alias("n_lines")
    )


def without_residue(documents: DataFrame) -> DataFrame:
    """The documents that have no residue, with all their columns."""
    return documents.join(residue(documents), "doc_id", "left_anti")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue(table(spark, sf_dir, "documents")).select("doc_id")


def p10_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents of each kind are left without residue."""
    return without_residue(table(spark, sf_dir, "documents").select("doc_id", "text", "doc_kind")).groupBy("doc_kind").agg(
        F.count("*").alias("n_documents")
    )
