"""Licence scan by sentence rules, with DataFrame and SQL functions only.

A text is cut into pieces (end marks before white space, and line ends) and normalised to lower-case ASCII
letters and digits with single blanks, so comment marks vanish.  A line end without an end mark, a blank line
or a bracketed bullet may be a wrapped line, so it ends a piece, but no sentence.  A *known* sentence is one or
more pieces that together are in the table of licence sentences, however they are wrapped or cut; or a grant
of a licence by name ("... licensed under <name>"), also over a line end and with more words behind it.  Each
has an identifier.  Identifiers form a sequence in text order; where more than ``GAP`` sentences lie between
two known ones, the sequence is cut.  n_sentences is the number of pieces.  Rules are ordered sequences of identifiers, tried from the longest; what a rule has matched
is taken out before the next one.  Everything happens within a row: no shuffle.

Defined results: one row per row; a null, empty or unlicensed text has an empty list and no identifiers;
repeated rows and null ids give a row each; a licence that matches twice is listed once; licences are listed
in rule order; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import pick

GAP = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Normalised sentences of public licence texts and their identifiers.
SENTENCES = (
    ("mit-permission", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-as-is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit-liability", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsd-permission", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-endorse", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-as-is", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("isc-permission", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache-header", "licensed under the apache license version 2 0 the license"),
    ("apache-comply", "you may not use this file except in compliance with the license"),
    ("apache-basis", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-hope", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-copy", "you should have received a copy of the gnu general public license along with this program"),
    ("mpl-subject", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense-public", "this is free and unencumbered software released into the public domain"),
    ("unlicense-anyone", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
)
NAMES = (
    ("MIT", "mit license"), ("MIT", "mit"), ("ISC", "isc license"), ("Apache-2.0", "apache license version 2 0"), ("Apache-2.0", "apache license 2 0"), ("Apache-2.0", "apache 2 0"),
    ("GPL-3.0", "gnu general public license version 3"), ("GPL-3.0", "gnu gpl version 3"), ("GPL-3.0", "gpl 3 0"), ("GPL-3.0", "gplv3"), ("GPL-2.0", "gnu general public license version 2"), ("GPL-2.0", "gpl 2 0"), ("GPL-2.0", "gplv2"),
    ("LGPL-3.0", "gnu lesser general public license version 3"), ("AGPL-3.0", "gnu affero general public license version 3"), ("MPL-2.0", "mozilla public license version 2 0"), ("MPL-2.0", "mpl 2 0"),
    ("BSD-2-Clause", "bsd 2 clause license"), ("BSD-3-Clause", "bsd 3 clause license"), ("BSD-3-Clause", "bsd license"),
    ("CC-BY-4.0", "cc by 4 0"), ("CC-BY-SA-4.0", "cc by sa 4 0"), ("CC-BY-NC-4.0", "cc by nc 4 0"), ("CC-BY-ND-4.0", "cc by nd 4 0"), ("CC-BY-NC-SA-4.0", "cc by nc sa 4 0"), ("CC0-1.0", "cc0 1 0"),
    ("CC-BY-4.0", "creative commons attribution 4 0 international license"), ("CC-BY-SA-4.0", "creative commons attribution sharealike 4 0 international license"), ("CC-BY-NC-4.0", "creative commons attribution noncommercial 4 0 international license"),
)
# ordered rules: (licence, identifiers in order)
RULES = (
    ("MIT", "mit-permission mit-notice mit-as-is mit-liability"), ("BSD-3-Clause", "bsd-permission bsd-source bsd-binary bsd-endorse bsd-as-is"),
    ("BSD-3-Clause", "bsd-permission bsd-source bsd-binary bsd-endorse"), ("BSD-2-Clause", "bsd-permission bsd-source bsd-binary bsd-as-is"), ("MIT", "mit-permission mit-notice mit-as-is"),
    ("Apache-2.0", "apache-header apache-comply apache-basis"), ("GPL-3.0-or-later", "gpl-free gpl-hope gpl-copy"), ("BSD-2-Clause", "bsd-permission bsd-source bsd-binary"),
    ("Apache-2.0", "apache-header apache-comply"), ("GPL-3.0-or-later", "gpl-free gpl-hope"), ("Unlicense", "unlicense-public unlicense-anyone"), ("MIT", "mit-permission mit-notice"),
    ("MIT", "mit-permission"), ("ISC", "isc-permission"), ("Apache-2.0", "apache-header"), ("GPL-3.0-or-later", "gpl-free"), ("MPL-2.0", "mpl-subject"), ("Unlicense", "unlicense-public"),
)
# ends of sentences and of mere lines, and the mark of a known sentence
END, LINE, MARK = "\u0001", "\u0002", "\u0003"
BULLET = r"(?:^|\n)[^a-z0-9\n]*\(?(?:[0-9]{1,2}|[a-z])\)[ \t]+(?=[^a-z0-9.!?;\n]*[a-z0-9])"
# the bare word is also the name of a place: it needs an end or a known word behind it
BARE = {"mit": f"(?=[{END}{LINE}]|$| (?:or|and|see) )"}
NAME = "(?:" + "|".join((s + BARE.get(s, "")).replace(" ", f"[ {LINE}]") for s in sorted((s for _, s in NAMES), key=len, reverse=True)) + ")"
GRANT = (f"(?:(?<![a-z0-9])(?:licensed|released|distributed|available|published) under (?:the terms of )?(?:the |a )?".replace(" ", f"[ {LINE}]")
         + f"|(?<![^{END}{LINE}])spdx license identifier ){NAME}(?![a-z0-9])")
# grants by name come after the texts
ALL_RULES = RULES + tuple((name, f"name:{name}") for name in dict.fromkeys(n for n, _ in NAMES))


def licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, n_sentences, sentence_ids (blank-separated, '#' at cuts), licences (comma-separated)."""
    docs = pick(docs, doc_id=doc_id, text=text)
    plain = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    marked = F.regexp_replace(F.regexp_replace(plain, BULLET, END), r"[.!?;][ \t\r\n]+|\n[^a-z0-9\n" + END + r"]*(?=\n)", END)
    normal = F.regexp_replace(F.translate(marked, "\n", LINE), f"[^a-z0-9{END}{LINE}]+", " ")
    normal = F.regexp_replace(F.regexp_replace(normal, f" ?{LINE}[ {LINE}]*", LINE), f"[ {LINE}]*{END}[ {END}{LINE}]*", END)
    normal = F.btrim(normal, F.lit(f" {END}{LINE}"))
    names = F.create_map(*[F.lit(x) for n, s in NAMES for x in (s, f"name:{n}")])
    rows = docs.select("doc_id", normal.alias("t"))
    pieces = F.when(F.col("t") == "", 0).otherwise(F.size(F.split("t", f"[{END}{LINE}]")))
    # fold over the known sentences: (plain words, text with marks)
    known = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(f"(^|[{END}{LINE}])" + s.replace(" ", f"[ {END}{LINE}]") + f"(?=[{END}{LINE}]|$)").alias("p"), F.lit(f"$1{MARK}{i}{MARK}").alias("to")) for i, s in SENTENCES])
    both = F.struct(F.translate("t", END + LINE, "  ").alias("w"), F.col("t").alias("t"))
    seen = F.aggregate(known, both, lambda acc, k: F.struct(acc["w"].alias("w"), F.when(F.contains(acc["w"], k["s"]), F.regexp_replace(acc["t"], k["p"], k["to"])).otherwise(acc["t"]).alias("t")))
    rows = rows.select("doc_id", pieces.cast("long").alias("n_sentences"), seen.alias("f"))
    may = F.contains("f.t", F.lit(MARK)) | F.contains("f.w", F.lit("under ")) | F.contains("f.w", F.lit("spdx "))
    found = F.when(may, F.regexp_extract_all("f.t", F.lit(f"{MARK}[^{MARK}]+{MARK}|{GRANT}|{END}"), F.lit(0))).otherwise(F.array().cast("array<string>"))

    def identify(x):
        name = F.translate(F.regexp_extract(x, f"(?<![a-z0-9])({NAME})$", 1), LINE, " ")
        return F.when(F.startswith(x, F.lit(MARK)), F.translate(x, MARK, "")).otherwise(F.element_at(names, name))

    # fold over what was found: (sentence ends since the last known sentence, identifiers so far)
    start = F.struct(F.lit(0).alias("i"), F.lit("").alias("q"))
    step = F.aggregate(found, start, lambda acc, x: F.when(x == END, F.struct((acc["i"] + 1).alias("i"), acc["q"].alias("q"))).otherwise(
        F.struct(F.lit(0).alias("i"), F.concat(acc["q"], F.when(acc["q"] == "", "").when(acc["i"] > GAP + 1, " # ").otherwise(" "), identify(x)).alias("q"))))
    rows = rows.select("doc_id", "n_sentences", step["q"].alias("sentence_ids"))
    # fold over the rules: (what is left of the sequence, licences so far)
    state = F.struct(F.concat(F.lit(" "), "sentence_ids", F.lit(" ")).alias("q"), F.array().cast("array<string>").alias("l"))
    rules = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(f" {r} ").alias("r")) for n, r in ALL_RULES])
    fold = F.aggregate(rules, state, lambda acc, r: F.when(F.contains(acc["q"], r["r"]), F.struct(F.replace(F.replace(acc["q"], r["r"], F.lit(" # ")), r["r"], F.lit(" # ")).alias("q"), F.concat(acc["l"], F.array(r["n"])).alias("l"))).otherwise(acc))
    got = F.when(F.col("sentence_ids") == "", F.lit("")).otherwise(F.array_join(F.array_distinct(fold["l"]), ","))
    return rows.select("doc_id", "n_sentences", "sentence_ids", got.alias("licences"))


def oracle() -> str:
    """The same result in DuckDB, by unnesting, joins and aggregates instead of folds within a row."""
    values = lambda rows: ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
    parts = [(k, n, r) for k, (n, r) in enumerate(ALL_RULES)]
    cte = [f"known(id, s) AS (VALUES {values(SENTENCES)})", f"names(n, s) AS (VALUES {values(NAMES)})",
           f"cut AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split(trim(regexp_replace(regexp_replace(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.!?;][ \\t\\r\\n]+|\\n', chr(1), 'g'), '[^a-z0-9\\x01]+', ' ', 'g'), ' ?\\x01 ?', chr(1), 'g')), chr(1)), lambda x: x <> '') AS s FROM documents)",
           "one AS (SELECT r, unnest(s) AS s, generate_subscripts(s, 1) AS i FROM cut)",
           "hit AS (SELECT o.r, o.i, coalesce(k.id, 'name:' || n.n) AS id FROM one o LEFT JOIN known k ON k.s = o.s LEFT JOIN names n ON k.id IS NULL AND n.s = "
           "CASE WHEN o.s LIKE 'spdx license identifier %' THEN substr(o.s, 25) WHEN regexp_matches(o.s, '^(.* )?(licensed|released|distributed|available|published) under ') THEN regexp_replace(o.s, '^(.* )?(licensed|released|distributed|available|published) under (the terms of )?(the |a )?', '') END WHERE k.id IS NOT NULL OR n.n IS NOT NULL)",
           f"spaced AS (SELECT r, i, id, CASE WHEN lag(i) OVER w IS NULL THEN '' WHEN i - lag(i) OVER w > {GAP + 1} THEN ' # ' ELSE ' ' END || id AS piece FROM hit WINDOW w AS (PARTITION BY r ORDER BY i))",
           "seq AS (SELECT r, string_agg(piece, '' ORDER BY i) AS q FROM spaced GROUP BY r)", "q0 AS (SELECT r, ' ' || q || ' ' AS q, '' AS l FROM seq)"]
    for k, n, r in parts:
        cte.append(f"q{k + 1} AS (SELECT r, replace(replace(q, ' {r} ', ' # '), ' {r} ', ' # ') AS q, l || CASE WHEN contains(q, ' {r} ') AND NOT contains(l || ',', ',{n},') THEN ',{n}' ELSE '' END AS l FROM q{k})")
    return ("WITH " + ", ".join(cte) + f" SELECT c.doc_id, CAST(len(c.s) AS BIGINT) AS n_sentences, coalesce(s.q, '') AS sentence_ids, coalesce(substr(f.l, 2), '') AS licences "
            f"FROM cut c LEFT JOIN seq s USING (r) LEFT JOIN q{len(parts)} f USING (r)")
