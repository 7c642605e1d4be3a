"""License scans by ordered signature rules, in Spark expressions only.

A text is reduced to its words (each written between blanks), so rules need no care for case, line
ends or punctuation.  Hundreds of hand-written regular expressions look for license tags, grants, names
and passages of license texts.  They are gated twice: a text that holds none of a few roots is not looked at
further, and a rule is tried only where the text holds its keyword.  The texts that remain are scanned within their row, without
a shuffle.

Rules are ordered.  A find inside a longer find of the same or a higher priority is dropped, and of finds on
the same words the first rule's stays; so a name inside a grant, or a family inside one of its versions,
does not count.  Base phrases are never dropped.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Every rule's finds hold one of these (as words between blanks are written: two blanks between words).
ROOTS = ["licen", "cc  by", "cc0", "gpl", "creative  commons", "public  domain", "permission  is", "redistribution  and  use",
         "wtfpl", "hereby  granted", "free  software", "warranty  of  any  kind", "altered  source  versions"]


class Rule(NamedTuple):
    label: str
    keyword: str
    pattern: str
    priority: int
    strength: float


#: Names of licenses: label, keyword, and the words of the name; ``L`` stands for "licence" in either spelling.
#: The name of a version stands above the family's.
NAMES = r"""
agpl-3-or-later | affero | (gnu )?affero general public L (version |v ?)?3( 0)? or (any )?later( version)?
agpl-3 | affero | (gnu )?affero general public L (version |v ?)?3( 0)?( only)?
agpl-1 | affero | affero general public L (version |v ?)?1( 0)?
agpl | affero | (gnu )?affero general public L
lgpl-3-or-later | lesser | (gnu )?lesser general public L (version |v ?)?3( 0)? or (any )?later( version)?
lgpl-2.1-or-later | lesser | (gnu )?lesser general public L (version |v ?)?2 1 or (any )?later( version)?
lgpl-3 | lesser | (gnu )?lesser general public L (version |v ?)?3( 0)?( only)?
lgpl-2.1 | lesser | (gnu )?lesser general public L (version |v ?)?2 1( only)?
lgpl | lesser | (gnu )?lesser general public L
lgpl-2 | library | (gnu )?library general public L (version |v ?)?2( 0)?
lgpl | library | (gnu )?library general public L
gpl-3-or-later | general | (gnu )?general public L (version |v ?)?3( 0)? or (any )?later( version)?
gpl-2-or-later | general | (gnu )?general public L (version |v ?)?2( 0)? or (any )?later( version)?
gpl-1-or-later | general | (gnu )?general public L (version |v ?)?1( 0)? or (any )?later( version)?
gpl-3 | general | (gnu )?general public L (version |v ?)?3( 0)?( only)?
gpl-2 | general | (gnu )?general public L (version |v ?)?2( 0)?( only)?
gpl-1 | general | (gnu )?general public L (version |v ?)?1( 0)?( only)?
gpl | general | gnu general public L
gpl-2-classpath | classpath | (gnu )?general public L (version |v ?)?2( 0)? with (the )?(gnu )?classpath exception
gfdl-1.3 | documentation | (gnu )?free documentation L (version |v ?)?1 3
gfdl-1.2 | documentation | (gnu )?free documentation L (version |v ?)?1 2
gfdl-1.1 | documentation | (gnu )?free documentation L (version |v ?)?1 1
gfdl | documentation | (gnu )?free documentation L
apache-2 | apache | apache( software)? L (version |v ?)?2( 0)?
apache-1.1 | apache | apache( software)? L (version |v ?)?1 1
apache-1 | apache | apache( software)? L (version |v ?)?1 0
apache | apache | apache( software)? L
mit | mit | mit L
mit-0 | mit | mit no attribution L
x11 | x11 | (mit )?x11 L
expat | expat | expat L
bsd-0 | bsd | (0|zero) clause bsd L
bsd-1 | bsd | (1|one) clause bsd L
bsd-2 | bsd | (2|two) clause bsd L
bsd-3 | bsd | (3|three) clause bsd L
bsd-4 | bsd | (4|four) clause bsd L
bsd-2 | simplified | simplified bsd L
bsd-2 | freebsd | freebsd L
bsd-3 | bsd | (new|revised|modified) bsd L
bsd-3 | new | new bsd L
bsd-4 | bsd | (original|old) bsd L
bsd-3-clear | clear | (3 clause )?clear bsd L
bsd-2-patent | patent | bsd (2 clause )?plus patent L
bsd | bsd | bsd( style)? L
isc | isc | isc L
zlib | zlib | zlib( libpng)? L
libpng | libpng | libpng L( version 2)?
bsl-1 | boost | boost software L (version |v ?)?1( 0)?
bsl | boost | boost software L
mpl-2 | mozilla | mozilla public L (version |v ?)?2( 0)?
mpl-1.1 | mozilla | mozilla public L (version |v ?)?1 1
mpl-1 | mozilla | mozilla public L (version |v ?)?1( 0)?
mpl | mozilla | mozilla public L
epl-2 | eclipse | eclipse public L (version |v ?)?2( 0)?
epl-1 | eclipse | eclipse public L (version |v ?)?1( 0)?
epl | eclipse | eclipse public L
edl-1 | eclipse | eclipse distribution L (version |v ?)?1( 0)?
cddl-1.1 | distribution | common development and distribution L (version |v ?)?1 1
cddl-1 | distribution | common development and distribution L (version |v ?)?1( 0)?
cddl | distribution | common development and distribution L
cpl-1 | common | common public L (version |v ?)?1( 0)?
cpal-1 | attribution | common public attribution L (version |v ?)?1( 0)?
eupl-1.2 | european | european union public L (version |v ?)?1 2
eupl-1.1 | european | european union public L (version |v ?)?1 1
eupl | european | european union public L
cecill-2.1 | cecill | cecill (free software )?L (version |v ?)?2 1
cecill-b | cecill | cecill b( free software)? L
cecill-c | cecill | cecill c( free software)? L
cecill | cecill | cecill( free software)? L
artistic-2 | artistic | artistic L (version |v ?)?2( 0)?
artistic-1 | artistic | artistic L (version |v ?)?1( 0)?
artistic | artistic | artistic L
perl | perl | same (terms as|L as) perl( itself)? L
python-2 | licen | (python software foundation|psf) L (version |v ?)?2
psf | python | python software foundation L
python | python | python L
php-3.01 | php | php L (version |v ?)?3 01
php-3 | php | php L (version |v ?)?3( 0)?
php | php | php L
ruby | ruby | ruby L
postgresql | postgresql | postgresql L
openssl | openssl | openssl L
unlicense | unlicense | (the )?unlicense
wtfpl | fuck | do what the fuck you want to public L( version 2)?
wtfpl | wtfpl | wtfpl( L)?( version 2)?
cc0 | cc0 | cc0( 1 0)?( universal)? L
beerware | beerware | beerware L( revision 42)?
afl-3 | academic | academic free L (version |v ?)?3( 0)?
afl-2.1 | academic | academic free L (version |v ?)?2 1
afl | academic | academic free L
osl-3 | open | open software L (version |v ?)?3( 0)?
osl | open | open software L
ecl-2 | educational | educational community L (version |v ?)?2( 0)?
upl-1 | universal | universal permissive L (version |v ?)?1( 0)?
ms-pl | microsoft | microsoft public L
ms-rl | microsoft | microsoft reciprocal L
mulan-2 | mulan | mulan permissive software L (version |v ?)?2
nasa-1.3 | nasa | nasa open source agreement L( version)? 1 3
ncsa | illinois | university of illinois( ncsa)? open source L
lppl-1.3c | latex | latex project public L (version |v ?)?1 3c
lppl | latex | latex project public L
ofl-1.1 | font | (sil )?open font L (version |v ?)?1 1
ofl | font | (sil )?open font L
qpl-1 | q  public | q public L (version |v ?)?1( 0)?
sleepycat | sleepycat | sleepycat L
sspl-1 | server | server side public L (version |v ?)?1
busl-1.1 | business | business source L (version |v ?)?1 1
busl | business | business source L
elastic-2 | elastic | elastic L (version |v ?)?2( 0)?
confluent-1 | confluent | confluent community L (version |v ?)?1( 0)?
commons-clause | commons | commons clause L condition
polyform-nc | polyform | polyform noncommercial L( 1 0 0)?
polyform | polyform | polyform [a-z]+ L
ipl-1 | ibm | ibm public L (version |v ?)?1( 0)?
intel | intel | intel open source L
w3c | w3c | w3c software( notice and)? L
vim | vim | vim L
zpl-2.1 | zope | zope public L (version |v ?)?2 1
zpl | zope | zope public L
watcom | watcom | sybase open watcom public L
rpl-1.5 | reciprocal | reciprocal public L (version |v ?)?1 5
spl | sun | sun public L
npl | netscape | netscape public L
apsl-2 | apple | apple public source L (version |v ?)?2( 0)?
apsl | apple | apple public source L
naist | nara | nara institute of science and technology L
hpnd | historical | historical permission notice and disclaimer L
curl | curl | curl L
fair | fair | fair L
mirosl | miros | miros L
eiffel | eiffel | eiffel forum L( version 2)?
entessa | entessa | entessa public L
frameworx | frameworx | frameworx open L
simple-2 | simple | simple public L (version |v ?)?2( 0)?
nosl | nethack | nethack general public L
nposl-3 | profit | non profit open software L (version |v ?)?3( 0)?
odbl-1 | database | (open data commons )?open database L( odbl)?( (version |v ?)?1 0)?
odc-by-1 | attribution | open data commons attribution L( (version |v ?)?1 0)?
pddl-1 | domain | (open data commons )?public domain dedication and L( (version |v ?)?1 0)?
cdla-permissive | community | community data L agreement permissive( (version |v ?)?[12] 0)?
cdla-sharing | community | community data L agreement sharing( (version |v ?)?1 0)?
ogl-uk-3 | government | open government L (version |v ?)?3( 0)?
ogl-uk | government | open government L
etalab-2 | etalab | L (ouverte )?etalab 2 0
openrail-m | licen | (bigscience )?(open rail|openrail)( m)? L
rail | responsible | responsible ai L
llama-3 | llama | llama 3( [123])? community L
llama-2 | llama | llama 2 community L
gemma | gemma | gemma L
dco | contributor | contributor L agreement
proprietary | proprietary | proprietary L
commercial | commercial | commercial L
site | site | site L
shareware | shareware | shareware L
""".replace("L", "licen[cs]e")

#: Creative Commons terms, in words and in letters, by version and jurisdiction port.
COMMONS = r"""
cc-by-nc-nd | attribution non ?commercial no ?deriv(s|atives|ative works) | by nc nd
cc-by-nc-sa | attribution non ?commercial share ?alike | by nc sa
cc-by-nc | attribution non ?commercial | by nc
cc-by-nd | attribution no ?deriv(s|atives|ative works) | by nd
cc-by-sa | attribution share ?alike | by sa
cc-by | attribution | by
"""

#: Passages of license texts: label, keyword, words.
NOTICES = r"""
mit | hereby | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | hereby | permission is hereby granted free of charge to any person obtaining a copy
isc | purpose | permission is hereby granted to use copy modify and or distribute this software for any purpose with or without fee
isc | purpose | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
hpnd | granted | permission is granted to use copy modify and distribute this software and its documentation
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-4 | advertising | redistribution and use in source and binary forms( [a-z0-9]+){1,90}? all advertising materials mentioning features
gpl | redistribute | (this program|this library|it) is free software you can redistribute it and or modify it
gpl-3-or-later | either | free software foundation either version 3 of the licen[cs]e or (at your option )?any later version
gpl-2-or-later | either | free software foundation either version 2 of the licen[cs]e or (at your option )?any later version
lgpl-2.1-or-later | either | free software foundation either version 2 1 of the licen[cs]e or (at your option )?any later version
apache-2 | apache | licen[cs]ed under the apache licen[cs]e version 2 0 the licen[cs]e you may not use this file except in compliance with the licen[cs]e
apache-2 | org | www apache org licen[cs]es licen[cs]e 2 0
mit | org | opensource org licen[cs]es? mit
bsd-3 | org | opensource org licen[cs]es? bsd 3 clause
bsd-2 | org | opensource org licen[cs]es? bsd 2 clause
gpl-3 | gnu | gnu org licen[cs]es gpl 3 0
gpl-2 | gnu | gnu org licen[cs]es (old licen[cs]es )?gpl 2 0
gpl | gnu | gnu org licen[cs]es gpl
lgpl-3 | gnu | gnu org licen[cs]es lgpl 3 0
lgpl | gnu | gnu org licen[cs]es lgpl
agpl-3 | gnu | gnu org licen[cs]es agpl 3 0
agpl | gnu | gnu org licen[cs]es agpl
gfdl | gnu | gnu org licen[cs]es fdl
mpl-2 | mozilla | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
mpl-2 | mozilla | mozilla org (en us )?mpl 2 0 licen[cs]e
cc0 | creativecommons | creativecommons org publicdomain zero 1 0 licen[cs]e
unlicense | unencumbered | this is free and unencumbered software released into the public domain
unlicense | unlicen | unlicen[cs]e org
public-domain | dedicated | dedicated to the public domain
public-domain | domain | (released|placed|donated) (in|into|to) the public domain
wtfpl | fuck | you just do what the fuck you want to licen[cs]e
zlib | altered | altered source versions must be plainly marked as such
bsl-1 | boost | distributed under the boost software licen[cs]e version 1 0 see accompanying file
postgresql | university | in no event shall the university of california be liable to any party( [a-z0-9]+){1,80}? licen[cs]e
python | beopen | beopen python open source licen[cs]e agreement
beerware | beer | you can buy me a beer in return( [a-z0-9]+){0,20}? licen[cs]e
ofl-1.1 | font | this font software is licen[cs]ed under the sil open font licen[cs]e version 1 1
epl-2 | eclipse | accompanying materials are made available under the terms of the eclipse public licen[cs]e v(ersion )? ?2 0
epl-1 | eclipse | accompanying materials are made available under the terms of the eclipse public licen[cs]e v(ersion )? ?1 0
dual | dual | dual licen[cs]ed
proprietary | written | may not be (copied|reproduced|distributed)( [a-z0-9]+){0,30}? without (prior |express )?written (permission|consent)( [a-z0-9]+){0,20}? licen[cs]e
no-warranty | warranty | without warranty of any kind
other | licen | licen[cs]ed under the( [a-z0-9]+){1,6}? licen[cs]e
"""

#: Identifiers that a tag may carry beside the labels above, written as words.
TAGS = ["0bsd", "bsl 1 0", "cc pddc", "ncsa", "ntp", "ofl 1 1", "openldap 2 8", "oset pl 2 1", "ruby", "sissl", "smlnj", "tcl", "unicode 3 0", "vsl 1 0", "xpp", "zend 2 0"]

_GRANT = "(licen[cs]ed|released|distributed|published|available|provided|covered|offered|shared|used) (only )?under (the )?(terms (and conditions )?of (the )?)?"


def _table(text: str) -> list[list[str]]:
    return [[f.strip() for f in line.split(" | ")] for line in text.strip().splitlines()]


def _words(pattern: str) -> str:
    """A pattern over words, for text in which every word stands between two blanks of its own."""
    return f" {pattern} ".replace(" ", "\0").replace("\0?", " ? ?").replace("\0", "  ")[1:-1]


def rules() -> list[Rule]:
    """All rules in order: base phrases, tags, passages and grants, then bare names."""
    names = _table(NAMES)
    out = [Rule(label, phrase.replace(" ", "  "), phrase, 3, 0.95) for phrase, label in BASE.items()]
    tags = {label: label.replace("-", " ").replace(".", " ") for label, *_ in names} | {t.replace(" ", "-"): t for t in TAGS}
    tags |= {label: "cc " + letters for label, _, letters in _table(COMMONS)}
    for label, words in sorted(tags.items(), key=lambda t: (-len(t[1]), t)):
        family = words.removesuffix(" or later")
        last = " or later" if family != words else "( only)?"
        out.append(Rule(label, "identifier", f"spdx licen[cs]e identifier {family}( 0)?{last}", 4, 1.0))
    out += [Rule(label, keyword, pattern, 3, 0.4 if label in ("other", "no-warranty", "dual") else 0.95) for label, keyword, pattern in _table(NOTICES)]
    for label, keyword, name in names:
        out.append(Rule(label, keyword, _GRANT + f"({name})", 3, 0.95))
    for label, words, letters in _table(COMMONS):
        last = "( [1234] 0)?( (international|unported|generic|universal))?"
        out.append(Rule(label, "cc  by", _GRANT + f"(a )?cc {letters}{last}", 3, 0.95))
        out.append(Rule(label, "creative  commons", _GRANT + f"(a )?creative commons {words}{last}( licen[cs]e)?", 3, 0.95))
        out.append(Rule(label, "creativecommons", f"creativecommons org licen[cs]es {letters}( [1234] 0)?", 3, 0.95))
    for label, keyword, name in names:
        out.append(Rule(label, keyword, name, 2, 0.8))
    for label, words, letters in _table(COMMONS):
        last = "( [1234] 0)?( (international|unported|generic|universal))?"
        out.append(Rule(label, "cc  by", f"cc {letters}{last}", 2, 0.8))
        out.append(Rule(label, "creative  commons", f"creative commons {words}{last}( licen[cs]e)?", 2, 0.8))
    out.append(Rule("cc0", "cc0", "cc0( 1 0)?( universal)?", 2, 0.8))
    out.append(Rule("creative-commons", "creative  commons", "creative commons( licen[cs]e)?", 1, 0.5))
    for family in ("agpl", "lgpl", "gpl"):
        for version in ("3", "2 1", "2"):
            out.append(Rule(f"{family}-{version.replace(' ', '.')}", family, f"(gnu )?{family}( version)? ?v?{version}( 0)?", 2, 0.8))
        out.append(Rule(family, family, f"gnu {family}", 2, 0.7))
    return [Rule(r.label, r.keyword, _words(r.pattern), r.priority, r.strength) for r in sorted(out, key=lambda r: -r.priority)]


_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FIND = "struct<label:string,rule:int,priority:int,strength:double,base:boolean,start:bigint,end:bigint>"


def spaced(text: Column) -> Column:
    """The words of a text, each between two blanks of its own; null and texts without words: empty."""
    words = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), _SEPARATORS, "  "))
    return F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def word_count(spaced_text: Column) -> Column:
    """Words in (a part of) a text made by ``spaced``."""
    return F.floor((F.octet_length(spaced_text) - F.octet_length(F.replace(spaced_text, F.lit(" "), F.lit("")))) / 2)


def _finds(words: Column, rule: Column) -> Column:
    """All finds of a rule: the pieces between the matches tell how many words stand before each."""
    matches = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    pieces = F.transform(F.split(words, rule["pattern"], -1), word_count)

    def step(seen: Column, i: Column) -> Column:
        start = seen["at"] + F.get(pieces, i)
        end = start + word_count(F.get(matches, i))
        find = F.struct(rule["label"].alias("label"), rule["rule"].alias("rule"), rule["priority"].alias("priority"),
                        rule["strength"].alias("strength"), rule["base"].alias("base"), start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(seen["out"], F.array(find)).alias("out"))

    none = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"CAST(array() AS array<{_FIND}>)").alias("out"))
    return F.when(F.size(matches) > 0, F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), none, step)["out"]).otherwise(none["out"])


def _kept(finds: Column) -> Column:
    """Sorted by start, longest first, then rule: a find is inside another if one before it, of its priority
    or a higher one, ends no earlier.  One pass with the farthest end per priority."""
    order = F.array_sort(F.transform(finds, lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("back"), d["rule"].alias("rule"), d.alias("find"))))
    levels = (1, 2, 3, 4)

    def step(seen: Column, o: Column) -> Column:
        d = o["find"]
        covered = F.lit(False)
        for p in levels:
            covered = covered | ((d["priority"] <= p) & (seen[f"far{p}"] >= d["end"]))
        far = [F.when(d["priority"] == p, F.greatest(seen[f"far{p}"], d["end"])).otherwise(seen[f"far{p}"]).alias(f"far{p}") for p in levels]
        return F.struct(*far, F.when(covered & ~d["base"], seen["out"]).otherwise(F.concat(seen["out"], F.array(d))).alias("out"))

    start = F.struct(*[F.lit(-1).cast("long").alias(f"far{p}") for p in levels], F.expr(f"CAST(array() AS array<{_FIND}>)").alias("out"))
    return F.aggregate(order, start, step)["out"]


def scan(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, n_words and finds (label, rule, priority, strength, base, start, end in words) of every row,
    sorted by start.  Null and empty texts have no words and no finds; repeated rows count each."""
    by_keyword: dict[str, list] = {}
    for k, r in enumerate(rules()):
        by_keyword.setdefault(r.keyword, []).append(
            {"label": r.label, "rule": k, "pattern": r.pattern, "priority": r.priority, "strength": r.strength, "base": r.pattern in map(_words, BASE)})
    table = F.from_json(F.lit(json.dumps([{"keyword": k, "rules": rs} for k, rs in by_keyword.items()])),
                        "array<struct<keyword:string,rules:array<struct<label:string,rule:int,pattern:string,priority:int,strength:double,base:boolean>>>>")
    gate = F.lit(False)
    for root in ROOTS:
        gate = gate | F.contains(F.col("__lowered"), F.lit(root))
    words = F.translate(F.col("__words"), _UPPER, _LOWER)
    tried = F.flatten(F.transform(F.filter(table, lambda k: F.contains(F.col("__low"), k["keyword"])), lambda k: k["rules"]))
    found = F.flatten(F.transform(tried, lambda r: _finds(F.col("__low"), r)))
    rows = df.select(*[F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)], spaced(F.col(text)).alias("__words"))
    # Lower-casing other letters too lets a few more texts pass the gate, but no rule.
    rows = rows.withColumn("__lowered", F.lower("__words")).withColumn("__low", F.when(gate, words))
    none = F.expr(f"CAST(array() AS array<{_FIND}>)")
    return rows.select(*[F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)], word_count(F.col("__words")).alias("n_words"),
                       F.when(F.col("__low").isNotNull(), _kept(found)).otherwise(none).alias("finds"))


def summary(scanned: DataFrame, keep: list[str]) -> DataFrame:
    """One row per row: n_base, first_word, last_word, base_labels, labels, score (the strength of the
    strongest find, 0 without one)."""
    base = F.filter("finds", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["start"])

    def labels(finds: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(finds, lambda d: d["label"]))), ",")

    return scanned.select(
        *keep, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("finds")).alias("labels"),
        F.coalesce(F.array_max(F.transform("finds", lambda d: d["strength"])), F.lit(0.0)).alias("score"))
