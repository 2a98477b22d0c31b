"""License scans by sentence rules.

A text is cut into sentences, each sentence is normalised (A-Z in lower case, all but
letters and digits as one blank) and looked up in a table of known licence sentences.
What remains of the text is a sequence of sentence identifiers with marks for unknown
sentences.  Ordered rules, each a sequence of identifiers that must follow one another,
are then matched against it: a rule takes the sentences it matches, so a short rule later
in the list does not see what a longer one has explained.

All of it is a chain of expressions on the row; nothing is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

BREAK = r"\n|[.!?]+[ \t\r\n]"
NOT_PLAIN = "[^a-z0-9]+"

# Known licence sentences, normalised, by identifier.
SENTENCES = {
    "apache-2.0-under": "licensed under the apache license version 2 0",
    "apache-2.0-comply": "you may not use this file except in compliance with the license",
    "apache-2.0-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind",
    "gpl-3.0-work": "this work is licensed under the gnu general public license version 3",
    "gpl-3.0-under": "licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "cc-by-nc-4.0-under": "licensed under cc by nc 4 0",
    "cc-by-4.0-under": "licensed under cc by 4 0",
    "cc-by-sa-4.0-under": "licensed under cc by sa 4 0",
    "bsd-redistribute": "redistribution and use in source and binary forms with or without modification are permitted",
    "bsd-no-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
}
# Ordered rules, longer ones before the rules they contain.
RULES = [
    ("Apache-2.0", ["apache-2.0-under", "apache-2.0-comply", "apache-2.0-copy"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is"]),
    ("BSD-3-Clause", ["bsd-redistribute", "bsd-no-endorse"]),
    ("GPL", ["gpl-free", "gpl-hope"]),
    ("Apache-2.0", ["apache-2.0-under"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-grant"]),
    ("GPL-3.0", ["gpl-3.0-work"]),
    ("GPL-3.0", ["gpl-3.0-under"]),
    ("GPL", ["gpl-free"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0-under"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4.0-under"]),
    ("CC-BY-4.0", ["cc-by-4.0-under"]),
    ("BSD-2-Clause", ["bsd-redistribute"]),
]
NAMES = sorted({name for name, _ in RULES})


def sentences(text: Column) -> Column:
    """Normalised sentences of a text, in order, those without a letter or digit left out."""
    plain = lambda s: F.trim(F.regexp_replace(lower_ascii(s), NOT_PLAIN, " "))
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), BREAK), plain), lambda s: s != "")


def _sequence(ids: list[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    known: dict[str, str] = SENTENCES,
    rules: list[tuple[str, list[str]]] = RULES,
) -> DataFrame:
    """(id, n_sentences, sentence_ids, licenses, n_matches) of every row.

    ``sentence_ids`` has the identifiers of known sentences in order of the text,
    ``licenses`` the names whose rules matched, sorted, each once, ``n_matches`` the number
    of matches.  A sentence that stands between two of a rule breaks the match.  Null, empty
    and license-free texts have empty lists.  Repeated rows each get their row; further
    columns are not looked at.
    """
    table = F.create_map(*[F.lit(x) for i, s in known.items() for x in (s, i)])
    start = docs.select(F.col(id_col).alias("id"), sentences(F.col(text_col)).alias("s"))
    looked_up = start.select("id", F.size("s").cast("long").alias("n"), F.transform("s", lambda s: table[s]).alias("ids"))
    mark = F.transform("ids", lambda i: F.when(i.isNull(), F.lit("<>")).otherwise(F.concat(F.lit("<"), i, F.lit(">"))))
    marked = looked_up.select("id", "n", F.filter("ids", lambda i: i.isNotNull()).alias("ids"), F.array_join(mark, "").alias("left"))

    def take(df: DataFrame, numbered: tuple[int, tuple[str, list[str]]]) -> DataFrame:
        k, (_, ids) = numbered
        pattern = _sequence(ids)
        rest = F.replace("left", F.lit(pattern), F.lit("<>"))
        gone = (F.length("left") - F.length(rest)) / F.lit(len(pattern) - 2)
        return df.select("id", "n", "ids", *[f"m{i}" for i in range(k)], gone.cast("long").alias(f"m{k}"), rest.alias("left"))

    matched = reduce(take, enumerate(rules), marked)
    hits = [F.when(F.col(f"m{k}") > 0, F.lit(name)) for k, (name, _) in enumerate(rules)]
    return matched.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_sentences"),
        F.col("ids").alias("sentence_ids"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*hits)))).alias("licenses"),
        reduce(Column.__add__, [F.col(f"m{k}") for k in range(len(rules))]).alias("n_matches"),
    )


def oracle() -> str:
    """The same scan in DuckDB's SQL, with its lists joined by commas."""
    known = ", ".join(f"('{s}', '{i}')" for i, s in SENTENCES.items())
    steps, left = [], "left0"
    for k, (_, ids) in enumerate(RULES):
        p = _sequence(ids)
        steps.append(
            f"r{k + 1} as (select * exclude (left{k}), replace(left{k}, '{p}', '<>') left{k + 1},"
            f" ((length(left{k}) - length(replace(left{k}, '{p}', '<>'))) // {len(p) - 2})::bigint m{k} from r{k})"
        )
        left = f"left{k + 1}"
    names = ", ".join(
        f"case when {' or '.join(f'm{k} > 0' for k, (n, _) in enumerate(RULES) if n == name)} then '{name}' end" for name in NAMES
    )
    total = " + ".join(f"m{k}" for k in range(len(RULES)))
    return f"""
with known(s, sid) as (values {known}),
parts as (
  select rid, doc_id, unnest(list_filter(list_transform(
    string_split_regex(coalesce(text, ''), '\\n|[.!?]+[ \\t\\r\\n]'),
    lambda x: trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'))),
    lambda x: x <> '')) s,
    generate_subscripts(list_filter(list_transform(
    string_split_regex(coalesce(text, ''), '\\n|[.!?]+[ \\t\\r\\n]'),
    lambda x: trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'))),
    lambda x: x <> ''), 1) pos
  from (select row_number() over () rid, doc_id, text from documents)),
seqs as (
  select rid, count(*) n, coalesce(string_agg(sid, ',' order by pos), '') ids,
    string_agg('<' || coalesce(sid, '') || '>', '' order by pos) seq
  from parts left join known using (s) group by rid),
r0 as (
  select d.doc_id, coalesce(n, 0)::bigint n_sentences, coalesce(ids, '') sentence_ids, coalesce(seq, '') left0
  from (select row_number() over () rid, doc_id from documents) d left join seqs using (rid)),
{", ".join(steps)}
select doc_id, n_sentences, sentence_ids, concat_ws(',', {names}) licenses, ({total})::bigint n_matches from r{len(RULES)}"""
