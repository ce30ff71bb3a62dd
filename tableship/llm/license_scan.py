"""License texts and notices: ordered signature rules over the words of a text.

A text becomes its words, in lower case and with single spaces. Rules are regular
expressions over such words; each names keywords, one of which is a word of whatever it matches,
and only rules with a keyword that stands in the text are tried. A place found by one rule that lies inside a place of a rule with a
higher priority, or of a longer match with the same priority, is dropped; of two rules with equal
priority that find the same place, the one that comes first in the list stays.

Only built-in functions are used, row by row and without a shuffle, so the number of
documents, hosts or copies does not matter. Null and empty texts have no words and no places;
repeated rows are separate rows, an empty table gives no rows. Very long texts are searched whole;
the places of one text are compared with each other. Input columns travel in a struct, so their names are free.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableship.llm.common import packed

#: What stands between words: ASCII apart from letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Fixed values of the contract: phrases that always count, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: What stands before a version number, its space included.
_V = r"(?:(?: version| ver| v)? | v)"
_LATER = r"(?: or (?:any later version|later|newer))?"

#: Names of licenses in words: label, keywords (with | between them), regular expression.
FAMILIES = (
    ("apache-1.1", "apache", r"apache(?: software)? license" + _V + "1 1"),
    ("apache-2.0", "apache", r"apache(?: software)?(?: license)?" + _V + "2(?: 0)?"),
    ("afl-3.0", "academic", r"academic free license" + _V + "3 0"),
    ("agpl-3.0", "affero", r"gnu affero general public license(?:" + _V + "3(?: 0)?)?" + _LATER),
    ("artistic-2.0", "artistic", r"artistic license(?:" + _V + "2(?: 0)?)?"),
    ("bsd-2-clause", "bsd|freebsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd)"),
    ("bsl-1.0", "boost", r"boost software license(?:" + _V + "1 0)?"),
    ("busl-1.1", "business", r"business source license(?:" + _V + "1 1)?"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-2.0", "cc", r"(?:creative commons )?cc by 2 0"),
    ("cc-by-3.0", "cc", r"(?:creative commons )?cc by 3 0"),
    ("cc-by-4.0", "cc", r"(?:creative commons )?cc by 4 0"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by", "commons", r"creative commons attribution(?: [1-4] [05])?(?: international)?"),
    ("cc-by-sa", "commons", r"creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc", "commons", r"creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-nd", "commons", r"creative commons attribution no ?derivatives(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "commons", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?"),
    ("cddl-1.0", "cddl|development", r"(?:common development and distribution license|cddl)(?: 1 0)?"),
    ("cecill-2.1", "cecill", r"cecill(?:" + _V + "2(?: 1)?)?"),
    ("cpl-1.0", "common", r"common public license(?:" + _V + "1 0)?"),
    ("ecl-2.0", "educational", r"educational community license(?:" + _V + "2 0)?"),
    ("epl-1.0", "eclipse", r"eclipse public license" + _V + "1 0"),
    ("epl-2.0", "eclipse", r"eclipse public license(?:" + _V + "2 0)?"),
    ("eupl-1.2", "european", r"european union public licen[cs]e(?:" + _V + "1 2)?"),
    ("gfdl-1.3", "documentation", r"gnu free documentation license(?:" + _V + "1 [1-3])?"),
    ("gpl-1.0", "general", r"(?:gnu )?general public license" + _V + "1(?: 0)?" + _LATER),
    ("gpl-2.0", "general", r"(?:gnu )?general public license" + _V + "2(?: 0)?" + _LATER),
    ("gpl-3.0", "general", r"(?:gnu )?general public license" + _V + "3(?: 0)?" + _LATER),
    ("gpl", "gpl|gplv1|gplv2|gplv3", r"(?:gnu )?gpl(?:v[123]|" + _V + "[123](?: 0)?)?" + _LATER),
    ("isc", "isc", r"isc license"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public license" + _V + "2(?: 1)?" + _LATER),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public license" + _V + "3(?: 0)?" + _LATER),
    ("lgpl-2.0", "general", r"(?:gnu )?library general public license" + _V + "2(?: 0)?" + _LATER),
    ("lgpl", "general", r"(?:gnu )?(?:lesser|library)(?: (?:or )?(?:lesser|library))? general public license"),
    ("lgpl", "lgpl|lgplv2|lgplv3", r"(?:gnu )?lgpl(?:v[23]|" + _V + "[23](?: [01])?)?" + _LATER),
    ("lppl-1.3", "latex", r"latex project public license(?:" + _V + "1 3[abc]?)?"),
    ("mit", "mit", r"mit(?: x11| expat)?"),
    ("mpl-1.1", "mozilla", r"mozilla public license" + _V + "1 [01]"),
    ("mpl-2.0", "mozilla", r"mozilla public license(?:" + _V + "2(?: 0)?)?"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("odbl-1.0", "database", r"open (?:data commons )?(?:open )?database license(?:" + _V + "1 0)?"),
    ("ofl-1.1", "font", r"(?:sil )?open font license(?:" + _V + "1 1)?"),
    ("osl-3.0", "open", r"open software license(?:" + _V + "3 0)?"),
    ("php-3.01", "php", r"php license(?:" + _V + "3 01?)?"),
    ("psf-2.0", "python", r"python software foundation license(?:" + _V + "2)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "public", r"do what the fuck you want to public license"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
)

#: Short forms as identifiers and notices write them: label, keywords, regular expression. Alone
#: they say little, so they count only where a use stands beside them.
SHORT = (
    ("0bsd", "0bsd", r"0bsd"),
    ("afl-3.0", "afl", r"afl(?:" + _V + "3(?: 0)?)?"),
    ("agpl-3.0", "agpl|agplv3", r"(?:gnu )?agpl(?:v3|" + _V + "3)?(?: 0)?(?: only)?" + _LATER),
    ("apache-1.1", "apache", r"apache" + _V + "1 [01]"),
    ("apache-2.0", "apachev2|asl|al2", r"(?:apachev2|asl" + _V + "2|al2)(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic" + _V + "[12](?: 0)?"),
    ("bsd-2-clause", "bsd", r"bsd" + _V + "2 clause(?: patent| views)"),
    ("bsd", "bsd", r"bsd(?: style)?"),
    ("bsl-1.0", "bsl", r"bsl" + _V + "1(?: 0)?"),
    ("busl-1.1", "busl|bsl", r"(?:busl(?:" + _V + "1 1)?|bsl 1 1)"),
    ("cpl-1.0", "cpl", r"cpl(?:" + _V + "1 0)?"),
    ("ecl-2.0", "ecl", r"ecl(?:" + _V + "[12] 0)?"),
    ("epl-1.0", "epl|eplv1", r"epl(?:v1|" + _V + "1)(?: 0)?"),
    ("epl-2.0", "epl|eplv2", r"epl(?:v2|" + _V + "2)(?: 0)?"),
    ("epl", "epl", r"epl"),
    ("eupl-1.2", "eupl", r"eupl(?:" + _V + "1 [12])?" + _LATER),
    ("gfdl-1.3", "gfdl|fdl", r"(?:gnu )?g?fdl(?:" + _V + "1 [123])?(?: no)?(?: invariants)?(?: only)?" + _LATER),
    ("gpl-2.0", "gpl|gplv2", r"(?:gnu )?gpl(?:v2|" + _V + "2)(?: 0)?(?: only)?" + _LATER),
    ("gpl-3.0", "gpl|gplv3", r"(?:gnu )?gpl(?:v3|" + _V + "3)(?: 0)?(?: only)?" + _LATER),
    ("isc", "isc", r"isc"),
    ("lgpl-2.1", "lgpl|lgplv2", r"(?:gnu )?lgpl(?:v2|" + _V + "2)(?: [01])?(?: only)?" + _LATER),
    ("lgpl-3.0", "lgpl|lgplv3", r"(?:gnu )?lgpl(?:v3|" + _V + "3)(?: 0)?(?: only)?" + _LATER),
    ("lppl-1.3", "lppl", r"lppl(?:" + _V + "1 [0-3][abc]?)?"),
    ("mit-0", "mit", r"mit(?: 0| no attribution)"),
    ("mpl-1.1", "mpl", r"mpl" + _V + "1 [01]"),
    ("mpl-2.0", "mpl|mplv2", r"mpl(?:v2|" + _V + "2)(?: 0)?(?: no copyleft exception)?"),
    ("mpl", "mpl", r"mpl"),
    ("ms-pl", "ms", r"ms pl"),
    ("ms-rl", "ms", r"ms rl"),
    ("odbl-1.0", "odbl", r"odbl(?:" + _V + "1 0)?"),
    ("odc-by-1.0", "odc", r"odc by(?: 1 0)?"),
    ("ofl-1.1", "ofl", r"(?:sil )?ofl(?:" + _V + "1 [01])?(?: no)?(?: rfn)?"),
    ("osl-3.0", "osl", r"osl(?:" + _V + "[123] [01])?"),
    ("pddl-1.0", "pddl", r"pddl(?: 1 0)?"),
    ("php-3.01", "php", r"php" + _V + "3(?: 01?)?"),
    ("psf-2.0", "psf|psfl|python", r"(?:psf|psfl|python)(?:" + _V + "2(?: 0(?: 1)?)?)"),
    ("sspl-1.0", "sspl", r"sspl(?:" + _V + "1(?: 0)?)?"),
    ("wtfpl", "wtfpl", r"wtfpl(?:" + _V + "2)?"),
)

#: Names that are as short as an identifier, so that tags hold them as they are.
TAG_WORDS = ("bsd", "bsd|freebsd", "cc", "cc0", "cddl|development", "cecill", "mit", "unlicense", "zlib",
             "gpl|gplv1|gplv2|gplv3", "lgpl|lgplv2|lgplv3", "apache")

#: How a name is used: name of the use, words around {0}, priority, trust in the finding.
USES = (
    ("tag", r"spdx license identifier {0}", 90, 0.99),
    ("grant", r"(?:licensed|released|distributed|published|available) under(?: the)?"
              r"(?: terms of)?(?: the)? {0}(?: licen[cs]e)?", 80, 0.95),
    ("subject", r"subject to(?: the)?(?: terms of)?(?: the)? {0}(?: licen[cs]e)?", 75, 0.9),
    ("title", r"(?:the )?{0} licen[cs]ed?", 60, 0.85),
)

#: Sentences that stand in a license or notice itself: label, keywords, words, priority, trust.
SENTENCES = (
    ("mit", "granted", r"permission is hereby granted free of charge to any person obtaining a copy", 95, 0.99),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose", 95, 0.99),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms", 95, 0.99),
    ("bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from", 95, 0.95),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software", 95, 0.95),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the license", 95, 0.95),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of", 95, 0.95),
    ("gpl", "verbatim", r"everyone is permitted to copy and distribute verbatim copies", 95, 0.95),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain", 95, 0.99),
    ("zlib", "origin", r"the origin of this software must not be misrepresented", 95, 0.95),
    ("bsl-1.0", "obtaining", r"organization obtaining a copy of the software and accompanying documentation", 95, 0.9),
    ("mpl-2.0", "source", r"this source code form is subject to the terms of", 95, 0.95),
    ("no-warranty", "warranty", r"without warranty of any kind", 40, 0.6),
    ("no-warranty", "warranties", r"without warranties or conditions of any kind", 40, 0.6),
    ("no-warranty", "merchantability|fitness", r"(?:merchantability|fitness for a particular purpose)", 30, 0.5),
    ("public-domain", "domain", r"(?:in|into|to) the public domain", 50, 0.7),
    ("public-domain", "domain", r"public domain", 20, 0.5),
    ("proprietary", "proprietary", r"proprietary and confidential", 50, 0.8),
    ("proprietary", "reproduction", r"(?:no|unauthori[sz]ed) reproduction", 40, 0.6),
    ("copyright", "copyright", r"copyright(?: c)? (?:19|20)[0-9][0-9](?: (?:19|20)?[0-9][0-9])?", 30, 0.6),
    ("copyright", "copyright", r"copyright", 10, 0.4),
    ("agpl-3.0", "interacting", r"interacting with (?:it|the software) remotely through a computer network", 95, 0.95),
    ("lgpl", "library", r"this library is free software you can redistribute it", 95, 0.95),
    ("epl", "accompanying", r"this program and the accompanying materials are made available under", 95, 0.9),
    ("mpl-1.1", "mozilla", r"contents of this file are subject to the mozilla public license", 95, 0.95),
    ("cddl-1.0", "cddl|development", r"contents of this file are subject to the terms of the (?:cddl|common development)", 95, 0.95),
    ("ofl-1.1", "font", r"this font software is licensed under the sil open font license", 95, 0.99),
    ("wtfpl", "fuck", r"you just do what the fuck you want to", 95, 0.99),
    ("artistic-2.0", "artistic|copyright", r"(?:same terms as perl itself under the artistic|copyright holder maintains some semblance of artistic control)", 95, 0.9),
    ("cc0-1.0", "waived", r"waived all copyright and related or neighbou?ring rights", 95, 0.95),
    ("busl-1.1", "production", r"make non production use of the licensed work", 95, 0.95),
    ("apache-1.1", "apache", r"this product includes software developed by the apache software foundation", 95, 0.9),
    ("openssl", "openssl", r"this product includes software developed by the openssl project", 95, 0.95),
    ("php-3.01", "php", r"this product includes php software freely available from", 95, 0.95),
    ("json", "evil", r"the software shall be used for good not evil", 95, 0.99),
    ("beerware", "beer", r"this stuff is worth it you can buy me a beer", 95, 0.99),
    ("hpnd", "supporting", r"that copyright notice and this permission notice appear in supporting documentation", 95, 0.95),
    ("sspl-1.0", "functionality", r"make the functionality of the program or a modified version available to third parties as a service", 95, 0.95),
    ("commons-clause", "sell", r"the license does not grant to you the right to sell the software", 95, 0.95),
    ("lppl-1.3", "latex", r"under the conditions of the latex project public license", 95, 0.95),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licenses by nc sa(?: [1-4] [05])?", 72, 0.95),
    ("cc-by-nc-nd", "creativecommons", r"creativecommons org licenses by nc nd(?: [1-4] [05])?", 72, 0.95),
    ("cc-by-nc", "creativecommons", r"creativecommons org licenses by nc(?: [1-4] [05])?", 71, 0.95),
    ("cc-by-nd", "creativecommons", r"creativecommons org licenses by nd(?: [1-4] [05])?", 72, 0.95),
    ("cc-by-sa", "creativecommons", r"creativecommons org licenses by sa(?: [1-4] [05])?", 72, 0.95),
    ("cc-by", "creativecommons", r"creativecommons org licenses by(?: [1-4] [05])?", 71, 0.95),
    ("mit", "opensource", r"opensource org licenses? mit", 72, 0.95),
    ("bsd", "opensource", r"opensource org licenses? bsd", 72, 0.9),
    ("apache-2.0", "apache", r"apache org licenses license 2 0", 72, 0.95),
    ("agpl-3.0", "gnu", r"gnu org licenses agpl", 72, 0.95),
    ("lgpl", "gnu", r"gnu org licenses lgpl", 72, 0.95),
    ("gpl", "gnu", r"gnu org licenses gpl", 72, 0.95),
    ("mpl-2.0", "mozilla", r"mozilla org mpl 2 0", 72, 0.95),
    ("epl", "eclipse", r"eclipse org legal epl", 72, 0.95),
    ("cc", "creativecommons", r"creativecommons org licenses [a-z]+(?: [a-z]+)?(?: [1-4] [05])?", 70, 0.9),
    ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero(?: 1 0)?", 70, 0.9),
    ("non-commercial", "commercial|noncommercial", r"(?:for )?non ?commercial (?:use|purposes)(?: only)?", 40, 0.6),
    ("permission", "permission", r"(?:used|reprinted|reproduced) (?:by|with) permission", 40, 0.6),
    ("license-file", "license", r"see (?:the )?license(?: file| txt| md)?(?: for)?", 30, 0.5),
)


@lru_cache(maxsize=1)
def rules() -> list[tuple[str, str, str, int, float, bool]]:
    """(label, keywords, regex, priority, trust, base): every use of every name and short form,
    the bare names of more than one word, the sentences and the base phrases."""
    made = [
        (label, keywords, words.format(name), priority, trust, False)
        for names in (SHORT, FAMILIES)
        for label, keywords, name in names
        for use, words, priority, trust in USES
        if use != "tag" or names is SHORT or keywords in TAG_WORDS
    ]
    made += [
        (label, keywords, name, 50, 0.7, False)
        for label, keywords, name in FAMILIES
        if keywords not in ("mit", "zlib", "apache", "unlicense")
    ]
    made += [(*sentence, False) for sentence in SENTENCES]
    made += [(label, words.split()[0], words, 55, 0.7, True) for words, label in BASE.items()]
    return made


def _gate() -> str:
    """A text without any of the keywords has no place of any rule."""
    words = sorted({word for _, keywords, *_ in rules() for word in keywords.split("|")})
    first = "".join(sorted({w[0] for w in words}))
    return f"(?i) (?=[{first}])(?:{'|'.join(words)}) "


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_words`` and ``places``: an array of (start, end,
    label, priority, trust, base, kept), in words from 0, end exclusive."""
    source = F.coalesce(F.col("row").getField(text), F.lit(""))
    joined = F.trim(F.regexp_replace(source, SEPARATORS, " "))
    rows = packed(docs).withColumn("words", F.concat(F.lit(" "), joined, F.lit(" ")))
    blanks = F.length("words") - F.length(F.replace(F.col("words"), F.lit(" "), F.lit("")))
    n_words = F.when(F.col("words") == "  ", 0).otherwise(blanks - 1).cast("long")
    # Only texts that pass the gate are lower-cased, A to Z alone.
    lower = F.translate("words", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    gated = F.when(F.col("words").rlike(_gate()), lower)
    rows = rows.select("row", n_words.alias("n_words"), gated.alias("words"))
    table = F.array(
        *(
            F.struct(
                F.lit(number).alias("number"),
                F.lit(label).alias("label"),
                F.array(*(F.lit(f" {word} ") for word in keywords.split("|"))).alias("keywords"),
                F.lit(f" (?:{regex})(?= )").alias("regex"),
                F.lit(priority).alias("priority"),
                F.lit(trust).alias("trust"),
                F.lit(base).alias("base"),
            )
            for number, (label, keywords, regex, priority, trust, base) in enumerate(rules())
        )
    )
    tried = F.filter(
        table, lambda r: F.exists(r["keywords"], lambda word: F.contains(F.col("words"), word))
    )
    found = F.flatten(F.transform(tried, lambda r: _places(F.col("words"), r)))
    # The empty array has the type of ``found``.
    rows = rows.withColumn("found", F.when(F.col("words").isNotNull(), found))
    rows = rows.withColumn("found", F.coalesce("found", F.array()))

    def outdone(p: Column, q: Column) -> Column:
        longer = (q["end"] - q["start"]) - (p["end"] - p["start"])
        inside = (q["start"] <= p["start"]) & (q["end"] >= p["end"])
        ahead = (q["priority"] > p["priority"]) | (
            (q["priority"] == p["priority"])
            & ((longer > 0) | ((longer == 0) & (q["number"] < p["number"])))
        )
        return inside & ahead

    def judged(p: Column) -> Column:
        kept = p["base"] | ~F.exists("found", lambda q: outdone(p, q))
        return F.struct(
            *(p[c].alias(c) for c in ("start", "end", "label", "priority", "trust", "base")),
            kept.alias("kept"),
        )

    places = F.array_sort(F.transform("found", judged))
    return rows.select("row", "n_words", places.alias("places"))


def _places(words: Column, rule: Column) -> Column:
    """Places of one rule. A marker word goes before each match, and its number among the
    words less the markers before it is where the match starts."""
    matches = F.regexp_extract_all(words, rule["regex"], F.lit(0))
    marked = F.regexp_replace(words, F.concat(F.lit("("), rule["regex"], F.lit(")")), F.lit(" \x01$1"))
    numbered = F.transform(F.split(F.substr(marked, F.lit(2)), " "), lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    marks = F.transform(F.filter(numbered, lambda x: x["w"] == "\x01"), lambda x, k: x["i"] - k)

    def place(at: Column, match: Column) -> Column:
        n = F.length(match) - F.length(F.replace(match, F.lit(" "), F.lit("")))
        return F.struct(
            at.alias("start"),
            (at + n).alias("end"),
            *(rule[c].alias(c) for c in ("number", "label", "priority", "trust", "base")),
        )

    return F.when(F.rlike(words, rule["regex"]), F.zip_with(marks, matches, place)).otherwise(
        F.filter(F.zip_with(F.array(F.lit(0)), F.array(F.lit("")), place), lambda _: F.lit(False))
    )
