"""Personal data: base patterns, and terms that give a protected entity away, with DataFrame functions only.

Base spans are emails, IP addresses, card numbers and phone numbers, each kind leftmost without overlaps. Patterns
are run in forms that match the same strings without repeated groups, so that runs of any length are safe: signs
that cannot belong to a match are first replaced by another sign of length one.

Information-theoretic sanitisation adds terms. The entities are the base values. For each entity e and each term
t, co-occurrence in the distinct texts of the corpus, each taken whole, gives PMI(t; e) = log(n(e,t) N / (n(e) n(t))),
and the disclosure of t is PMI over the entity's information content log(N / n(e)): 1 where the term occurs with the
entity only, about 0 where it tells nothing. Pairs that occur in at least `SUPPORT` distinct texts and reach `GENERALISE`
are marked wherever the term occurs in a text with the entity; from `REMOVE` on the sanitised text leaves the term out,
below that it names its class only. With less support than that any rare word would reach 1, so nothing is estimated.
Long hexadecimal strings of letters and digits (keys, tokens) carry more information than any term and are secrets of their own.

Counts are sums made before the shuffle. n(t) is counted over all texts, for terms that stand in enough texts with an
entity; these are broadcast only where a count shows that they are few. Pairs are made along the texts that hold an
entity, so their number grows with these, not with entities times terms.

Defined cases: null texts are empty; repeated rows get equal results; copies of a text count once. Ids may be
null or repeat. Empty tables give no rows. Texts of any length are taken whole. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Work, broadcast_if_small

KINDS = ("email", "ip", "card", "phone", "term", "secret")
SUPPORT = 3
GENERALISE, REMOVE = 0.75, 0.9

_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
#: A part of an IP address of at most 255, zeros before it allowed.
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_TERM = r"[\p{L}\p{N}]{2,}"
_SECRET = "(?<![A-Za-z0-9])[A-Fa-f0-9]{32,}(?![A-Za-z0-9])"
_NO_SPANS = "cast(array() as array<struct<s: int, k: int, e: int, v: string>>)"


def _found(text: str, pattern: str) -> str:
    """SQL: the matches of a pattern as (s, e, v): start and end in code points, and the text."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    return f"""
    aggregate(
      zip_with(slice(split({text}, '{quoted}', -1), 1, size(regexp_extract_all({text}, '{quoted}', 0))), regexp_extract_all({text}, '{quoted}', 0),
               (a, b) -> named_struct('a', char_length(a), 'n', char_length(b), 'v', b)),
      named_struct('at', 0, 'out', cast(array() as array<struct<s: int, e: int, v: string>>)),
      (acc, x) -> named_struct('at', acc.at + x.a + x.n, 'out', concat(acc.out, array(named_struct('s', acc.at + x.a, 'e', acc.at + x.a + x.n, 'v', x.v)))),
      acc -> acc.out)"""


def _replaced(text: str, pattern: str, sign: str) -> str:
    quoted = pattern.replace("\\", "\\\\")
    return f"regexp_replace({text}, '{quoted}', '{sign}')"


_LUHN = """aggregate(sequence(1, char_length(d)), 0, (acc, i) -> acc +
      if(i % 2 = 1, int(substr(d, -i, 1)), if(int(substr(d, -i, 1)) > 4, 2 * int(substr(d, -i, 1)) - 9, 2 * int(substr(d, -i, 1))))) % 10 = 0"""


def base_spans(text: str) -> Column:
    """Sorted array of (s, k, e, v): start, kind, end and normalised value, of a text column without nulls."""
    # an email: dots that do not stand between two label signs can be in its first part only, as % can
    email_text = _replaced(text, rf"(?<![{_LABEL}])[.]|[.](?![{_LABEL}])", "%")
    email = _found(email_text, rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]+@[{_LABEL}]+[.][{_LABEL}.]+")
    ip = _found(text, r"(?:\G|(?<![0-9]))[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+")
    # a card number: blanks and dashes that do not stand between two digits cannot be in it
    card_text = _replaced(text, r"(?<![0-9])[ -]|[ -](?![0-9])", "_")
    card = _found(card_text, r"[0-9][0-9 -]+")
    phone = _found(text, r"\+[0-9][ ().0-9-]+[0-9]")
    digits = lambda x: f"regexp_replace({x}, '[^0-9]', '')"
    empty = _NO_SPANS
    made = lambda found, k, value, keep: f"transform(filter(transform({found}, x -> named_struct('s', x.s, 'k', {k}, 'e', x.e, 'v', {value})), x -> {keep}), x -> x)"
    parts = [
        f"if(contains({text}, '@'), {made(email, 0, 'lower(x.v)', 'true')}, {empty})",
        rf"if(rlike({text}, '[0-9][.][0-9]'), {made(ip, 1, 'x.v', f"rlike(x.v, '^(?:{_PART}[.])(?:{_PART}[.])(?:{_PART}[.]){_PART}$')")}, {empty})",
        rf"if(rlike({text}, '[0-9][ -]?[0-9]'), {made(card, 2, digits('x.v'), f"if(char_length(x.v) between 12 and 19, element_at(transform(array(x.v), d -> {_LUHN}), 1), false)")}, {empty})",
        f"if(contains({text}, '+'), {made(phone, 3, digits('x.v'), 'char_length(x.v) between 9 and 15')}, {empty})",
    ]
    return F.expr(f"array_sort(concat({', '.join(parts)}))")


def _written(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, x -> concat(element_at(array({names}), x.k + 1), ':', x.s, ':', x.e)), ',')"


def _texts(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(*more, text.alias("_text"), F.md5(text).alias("_key"))


def disclosing_terms(docs: DataFrame, text_col: str = "text", support: int = SUPPORT, threshold: float = GENERALISE) -> DataFrame:
    """Stored table (entity, term, n_both, n_entity, n_term, n_texts, disclosure) of the pairs over the threshold."""
    return _estimates(docs, text_col, support, threshold, Work(docs.sparkSession))[0]


def _terms(text: str) -> Column:
    """The distinct terms of a text in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0)))


def _estimates(docs: DataFrame, text_col: str, support: int, threshold: float, work: Work) -> tuple[DataFrame, DataFrame]:
    """The pairs, and the entities of each distinct text: (_key, entity)."""
    texts = _texts(docs, text_col)
    # a text with n copies counts 1/n in each of them, so that sums are made before the shuffle
    copies = work.stored(texts.groupBy("_key").agg(F.count("*").alias("_n")), "copies")
    n_texts = copies.count()
    copied = broadcast_if_small(work.stored(copies.where("_n > 1"), "copied"))
    part = F.coalesce(1.0 / F.col("_n"), F.lit(1.0)).alias("_part")
    names = F.array(*map(F.lit, KINDS))
    found = texts.withColumn("_x", base_spans("_text")).where(F.size("_x") > 0)
    holding = found.select("_key", F.array_distinct(F.transform("_x", lambda x: F.concat_ws(":", F.get(names, x["k"]), x["v"]))).alias("entities"), _terms("_text").alias("terms"))
    holding = work.stored(holding, "occurrences")
    entities = work.stored(holding.select("_key", F.explode("entities").alias("entity")).distinct(), "entities")
    frequent = work.stored(entities.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support), "frequent")
    own = holding.join(copied, "_key", "left").select(part, "terms", F.explode("entities").alias("entity"))
    pairs = own.join(broadcast_if_small(frequent.select("entity")), "entity", "left_semi").select("entity", F.explode("terms").alias("term"), "_part")
    pairs = pairs.groupBy("entity", "term").agg(F.round(F.sum("_part")).cast("long").alias("n_both")).where(F.col("n_both") >= support)
    pairs = work.stored(pairs, "pairs")
    asked = work.stored(pairs.select("term").distinct(), "terms")
    words = texts.join(copied, "_key", "left").select(F.explode(_terms("_text")).alias("term"), part)
    counts = words.join(broadcast_if_small(asked), "term", "left_semi").groupBy("term").agg(F.round(F.sum("_part")).cast("long").alias("n_term"))
    total = F.lit(n_texts).cast("long")
    disclosure = F.when(total > F.col("n_entity"), F.log(F.col("n_both") * total / (F.col("n_entity") * F.col("n_term"))) / F.log(total / F.col("n_entity"))).otherwise(F.lit(0.0))
    scored = pairs.join(frequent, "entity").join(counts, "term").select("entity", "term", "n_both", "n_entity", "n_term", total.alias("n_texts"), disclosure.alias("disclosure"))
    return work.stored(scored.where(F.col("disclosure") >= threshold), "disclosing"), entities


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """id_col, text, base (array of s, k, e, v), all (base spans, secrets and terms; v of a term is what is put in its place),
    sanitised."""
    work = Work(docs.sparkSession)
    pairs, entities = _estimates(docs, text_col, support, generalise, work)
    marks = entities.join(broadcast_if_small(pairs.select("entity", "term", "disclosure")), "entity").groupBy("_key", "term").agg(F.max("disclosure").alias("d"))
    marks = marks.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("term", "d"))).alias("_marks"))
    marks = broadcast_if_small(work.stored(marks, "marks"), 20_000)
    work.drop_but("marks")
    rows = _texts(docs, text_col, F.col(id_col).alias("_id")).withColumn("_base", base_spans("_text")).join(marks, "_key", "left")
    outside = lambda spans, held: f"filter({spans}, x -> not exists({held}, b -> b.s < x.e and x.s < b.e))"
    secrets = f"""if(rlike(_text, '[A-Fa-f0-9]{{32}}'), transform(filter({_found("_text", _SECRET)}, x -> rlike(x.v, '[A-Fa-f]') and rlike(x.v, '[0-9]')),
      x -> named_struct('s', x.s, 'k', 5, 'e', x.e, 'v', '[SECRET]')), {_NO_SPANS})"""
    rows = rows.withColumn("_fixed", F.expr(f"concat(_base, {outside(secrets, '_base')})"))
    terms = f"""if(_marks is null, {_NO_SPANS}, transform(filter({_found("_text", _TERM)}, x -> map_contains_key(_marks, lower(x.v))),
      x -> named_struct('s', x.s, 'k', 4, 'e', x.e, 'v', if(_marks[lower(x.v)] >= {remove}, '', if(rlike(x.v, '^[0-9]+$'), '[NUMBER]', '[WORD]')))))"""
    rows = rows.withColumn("_all", F.expr(f"array_sort(concat(_fixed, {outside(terms, '_fixed')}))"))
    put = "if(x.k >= 4, x.v, concat('[', upper(element_at(array('email', 'ip', 'card', 'phone'), x.k + 1)), ']'))"
    clean = F.expr(f"""aggregate(_all, named_struct('at', 0, 'out', ''), (acc, x) -> if(x.s < acc.at, named_struct('at', greatest(acc.at, x.e), 'out', acc.out),
        named_struct('at', x.e, 'out', concat(acc.out, substr(_text, acc.at + 1, x.s - acc.at), {put}))), acc -> concat(acc.out, substr(_text, acc.at + 1)))""")
    return rows.select(F.col("_id").alias(id_col), F.col("_text").alias("text"), F.col("_base").alias("base"), F.col("_all").alias("all"), clean.alias("sanitised"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What `find` found, as counts, the digest of the base spans, all spans as a string, how many base spans, secrets and
    terms (removed, generalised) there are, and the digest of the sanitised text."""
    count = lambda when, name, spans="all": F.expr(f"size(filter({spans}, x -> {when}))").cast("long").alias(name)
    base = [count(f"x.k = {k}", f"n_{KINDS[k]}", "base") for k in range(4)]
    more = [count("x.k <> 4", "n_private"), count("x.k = 5", "n_secret"), count("x.k = 4 and x.v = ''", "n_removed"), count("x.k = 4 and x.v <> ''", "n_generalised")]
    return found.select(id_col, *base, F.sha2(F.expr(_written("base")), 256).alias("base_sha256"), F.expr(_written("all")).alias("spans"), *more, F.sha2("sanitised", 256).alias("sanitised_sha256"))
