"""License scans: ordered signature rules over words, native expressions only.

A rule is a regular expression over the normalised text, in which each word stands between two spaces of its own
(`` mit  license ``), so that word borders need no look-around. Rules are tried only where the text contains their
keyword. Each hit is an interval of words with the rule's level; an interval inside one of a higher level, or inside an
earlier or longer one of the same level, is suppressed. What remains gives labels and score.

Rows are independent, so there is no shuffle and no hot key. Null and empty text give no words, no hits, empty labels
and score 0. Equal intervals of one level keep the first rule. Repeated rows are repeated in the result; other columns
are not touched, except that the three result columns replace columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm.common import lower_ascii

#: Characters that are no part of a word once A-Z are lower case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases that always give their label.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: label; tag (identifier words); further names, each a rule: "a|b" alternatives for one word, "?" after an optional word.
SIGNATURES = """
mit; mit; mit license|licence; expat license|licence; x11 license|licence
mit-0; mit 0; mit no attribution
apache-1.0; apache 1 0; apache software? license|licence version? 1 0
apache-1.1; apache 1 1; apache software? license|licence version? 1 1
apache-2.0; apache 2 0; apache software? license|licence version? v2|2|2.0 0?; apache 2 0? license|licence; asl 2 0
apache; apache; apache license|licence; apache software license|licence
gpl-1.0; gpl 1 0; gnu? general public license|licence version? 1|v1; gplv1
gpl-2.0; gpl 2 0; gnu? general public license|licence version? 2|v2; gplv2; gpl version? 2|v2
gpl-2.0-or-later; gpl 2 0 or later; general public license|licence either? version 2 of the license or; gpl 2 or later; gplv2 or later
gpl-3.0; gpl 3 0; gnu? general public license|licence version? 3|v3; gplv3; gpl version? 3|v3
gpl-3.0-or-later; gpl 3 0 or later; general public license|licence either? version 3 of the license or; gpl 3 or later; gplv3 or later
gpl; gpl; general public license|licence; gnu gpl
lgpl-2.0; lgpl 2 0; gnu? library general public license|licence version? 2|v2; lgplv2 0?
lgpl-2.1; lgpl 2 1; gnu? lesser general public license|licence version? 2|v2 1; lgplv2 1
lgpl-3.0; lgpl 3 0; gnu? lesser general public license|licence version? 3|v3; lgplv3
lgpl; lgpl; lesser general public license|licence; library general public license|licence
agpl-1.0; agpl 1 0; affero general public license|licence version? 1|v1
agpl-3.0; agpl 3 0; gnu? affero general public license|licence version? 3|v3; agplv3
agpl; agpl; affero general public license|licence
gfdl-1.1; gfdl 1 1; free documentation license|licence version? 1 1
gfdl-1.2; gfdl 1 2; free documentation license|licence version? 1 2
gfdl-1.3; gfdl 1 3; free documentation license|licence version? 1 3
gfdl; gfdl; free documentation license|licence
bsd-1-clause; bsd 1 clause; 1|one clause bsd license|licence
bsd-2-clause; bsd 2 clause; 2|two clause bsd; simplified bsd license|licence; freebsd license|licence
bsd-3-clause; bsd 3 clause; 3|three clause bsd; new|modified|revised bsd license|licence
bsd-4-clause; bsd 4 clause; 4|four clause bsd; original|old bsd license|licence
bsd; bsd; bsd style? license|licence
0bsd; 0bsd; zero clause bsd; bsd zero clause
isc; isc; isc license|licence
mpl-1.0; mpl 1 0; mozilla public license|licence version? 1 0
mpl-1.1; mpl 1 1; mozilla public license|licence version? 1 1
mpl-2.0; mpl 2 0; mozilla public license|licence version? 2|v2 0?
mpl; mpl; mozilla public license|licence
epl-1.0; epl 1 0; eclipse public license|licence version? 1|v1 0?
epl-2.0; epl 2 0; eclipse public license|licence version? 2|v2 0?
epl; epl; eclipse public license|licence
cddl-1.0; cddl 1 0; common development and distribution license|licence version? 1 0
cddl-1.1; cddl 1 1; common development and distribution license|licence version? 1 1
cddl; cddl; common development and distribution license|licence
cpl-1.0; cpl 1 0; common public license|licence
cpal-1.0; cpal 1 0; common public attribution license|licence
ipl-1.0; ipl 1 0; ibm public license|licence
apsl-2.0; apsl 2 0; apple public source license|licence
artistic-1.0; artistic 1 0; artistic license|licence version? 1 0?
artistic-2.0; artistic 2 0; artistic license|licence version? 2 0?
artistic; artistic; artistic license|licence
bsl-1.0; bsl 1 0; boost software license|licence
busl-1.1; busl 1 1; business source license|licence
sspl-1.0; sspl 1 0; server side public license|licence
elastic-2.0; elastic 2 0; elastic license|licence version? 2|v2 0?
elastic; elastic; elastic license|licence
unlicense; unlicense; the unlicense
wtfpl; wtfpl; do what the fuck you want to public license|licence
zlib; zlib; zlib license|licence; zlib libpng license|licence
libpng; libpng; libpng license|licence
curl; curl; curl license|licence
openssl; openssl; openssl license|licence
postgresql; postgresql; postgresql license|licence
python-2.0; python 2 0; python software foundation license|licence; psf license|licence
php-3.01; php 3 01; php license|licence
ruby; ruby; ruby license|licence
vim; vim; vim license|licence
w3c; w3c; w3c software? notice? and? license|licence
unicode-3.0; unicode 3 0; unicode license|licence
ofl-1.1; ofl 1 1; sil? open font license|licence
eupl-1.1; eupl 1 1; european union public license|licence v?|version? 1 1
eupl-1.2; eupl 1 2; european union public license|licence v?|version? 1 2
eupl; eupl; european union public license|licence
ms-pl; ms pl; microsoft public license|licence
ms-rl; ms rl; microsoft reciprocal license|licence
ncsa; ncsa; university of illinois open source license|licence
afl-3.0; afl 3 0; academic free license|licence
osl-3.0; osl 3 0; open software license|licence
qpl-1.0; qpl 1 0; q public license|licence
sleepycat; sleepycat; sleepycat license|licence
mulanpsl-2.0; mulanpsl 2 0; mulan permissive software license|licence
cecill-2.1; cecill 2 1; cecill license|licence
lppl-1.3c; lppl 1 3c; latex project public license|licence
blueoak-1.0.0; blueoak 1 0 0; blue oak model license|licence
hippocratic-2.1; hippocratic 2 1; hippocratic license|licence
json; json; json license|licence; shall be used for good not evil
beerware; beerware; beer ware license|licence; beerware license|licence
odbl-1.0; odbl 1 0; open database license|licence
odc-by-1.0; odc by 1 0; open data commons attribution license|licence
pddl-1.0; pddl 1 0; public domain dedication and license|licence
cdla-permissive-2.0; cdla permissive 2 0; community data license|licence agreement permissive
cdla-sharing-1.0; cdla sharing 1 0; community data license|licence agreement sharing
openrail; openrail; responsible ai license|licence; openrail m? license|licence
cc0-1.0; cc0 1 0; cc0; creative commons zero
cc-by-1.0; cc by 1 0; creative commons attribution 1 0
cc-by-2.0; cc by 2 0; creative commons attribution 2 0
cc-by-2.5; cc by 2 5; creative commons attribution 2 5
cc-by-3.0; cc by 3 0; creative commons attribution 3 0
cc-by-4.0; cc by 4 0; creative commons attribution 4 0
cc-by-sa-2.0; cc by sa 2 0; creative commons attribution share|sharealike alike? 2 0
cc-by-sa-2.5; cc by sa 2 5; creative commons attribution share|sharealike alike? 2 5
cc-by-sa-3.0; cc by sa 3 0; creative commons attribution share|sharealike alike? 3 0
cc-by-sa-4.0; cc by sa 4 0; creative commons attribution share|sharealike alike? 4 0
cc-by-nc-2.0; cc by nc 2 0; creative commons attribution non|noncommercial commercial? 2 0
cc-by-nc-3.0; cc by nc 3 0; creative commons attribution non|noncommercial commercial? 3 0
cc-by-nc-4.0; cc by nc 4 0; creative commons attribution non|noncommercial commercial? 4 0
cc-by-nd-4.0; cc by nd 4 0; creative commons attribution no|noderivatives derivatives? 4 0
cc-by-nc-sa-4.0; cc by nc sa 4 0; creative commons attribution non|noncommercial commercial? share|sharealike alike? 4 0
cc-by-nc-nd-4.0; cc by nc nd 4 0; creative commons attribution non|noncommercial commercial? no|noderivatives derivatives? 4 0
cc; cc; creative commons license|licence; creative commons attribution
public-domain; public domain; released into the public domain; is in the public domain; dedicated to the public domain
proprietary; proprietary; all rights reserved; proprietary license|licence; confidential and proprietary
"""

#: Sentences of license texts themselves, for texts without the name of their license: label; sentences as above.
BODIES = """
mit; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files; to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute; the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit-0; to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and|or or? sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
x11; except as contained in this notice the name|names of the above|x copyright|consortium holders? shall not be used in advertising or otherwise to promote the sale use or other dealings
isc; permission to use copy modify and|or or? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice; the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness
0bsd; permission to use copy modify and|or or? distribute this software for any purpose with or without fee is hereby granted the software is provided as is
hpnd; permission to use copy modify and distribute this software and its documentation for any purpose and? without fee is hereby granted; not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission
postgresql; permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
ntp; permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted
bsd; redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met; redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer; redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause; neither the name of; may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause; all advertising materials mentioning features or use of this software must display the following acknowledgement|acknowledgment
bsd-2-clause-views; the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted as representing official policies
bsd-3-clause-clear; no express or implied licenses to any party s patent rights are granted by this license
ncsa; to deal with the software without restriction including without limitation the rights to use copy modify merge; redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers
apache-1.1; the end user documentation included with the redistribution if any must include the following acknowledgment; products derived from this software may not be called apache nor may apache appear in their name
apache-2.0; you may not use this file except in compliance with the license you may obtain a copy of the license at; unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis; without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations; you must cause any modified files to carry prominent notices stating that you changed the files; each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright|patent license
gpl; this program is free software you can redistribute it and or modify it under the terms of the gnu general public license; this program is distributed in the hope that it will be useful but without any warranty; you should have received a copy of the gnu general public license along with this program; everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed; when we speak of free software we are referring to freedom not price
gpl-2.0; the licenses for most software are designed to take away your freedom to share and change it; these requirements apply to the modified work as a whole if identifiable sections of that work are not derived from the program; you are not required to accept this license since you have not signed it however nothing else grants you permission to modify or distribute
gpl-3.0; the gnu general public license is a free copyleft license for software and other kinds of works; to propagate a work means to do anything with it that without permission would make you directly or secondarily liable for infringement; no covered work shall be deemed part of an effective technological measure
lgpl; this library is free software you can redistribute it and or modify it under the terms of the gnu lesser|library general public license; this library is distributed in the hope that it will be useful but without any warranty; you should have received a copy of the gnu lesser|library general public license along with this library
lgpl-2.1; this license the lesser general public license applies to some specially designated software packages typically libraries; a work that uses the library
lgpl-3.0; an application is any work that makes use of an interface provided by the library but which is not otherwise based on the library
agpl-3.0; if you modify the program your modified version must prominently offer all users interacting with it remotely through a computer network; specifically designed to ensure cooperation with the community in the case of network server software
agpl; you should have received a copy of the gnu affero general public license along with this program
gfdl; permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license; with no invariant sections no front cover texts and no back cover texts; the purpose of this license is to make a manual textbook or other functional and useful document free
mpl-1.1; the contents of this file are subject to the mozilla public license version; software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied see the license for the specific language governing rights and limitations; the initial developer of the original code is
mpl-2.0; this source code form is subject to the terms of the mozilla public license v 2 0; if a copy of the mpl was not distributed with this file you can obtain one at; this source code form is incompatible with secondary licenses
epl; the accompanying program is provided under the terms of this eclipse public license agreement; any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement
epl-2.0; this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
cddl-1.0; the contents of this file are subject to the terms of the common development and distribution license; when distributing covered code include this cddl header in each file
cpl-1.0; the accompanying program is provided under the terms of this common public license agreement
ipl-1.0; the accompanying program is provided under the terms of this ibm public license agreement
apsl-2.0; this file contains original code and or modifications of original code as defined in and that are subject to the apple public source license
artistic; the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control
artistic-2.0; this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed
bsl-1.0; permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license; the copyright notices in the software and this entire statement including the above license grant this restriction and the following disclaimer must be included
busl-1.1; the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work; effective on the change date or the fourth anniversary of the first publicly available distribution
sspl-1.0; if you make the functionality of the program or a modified version available to third parties as a service you must make the service source code available
elastic-2.0; you may not provide the software to third parties as a hosted or managed service where the service provides users with access to any substantial set of the features; you may not move change disable or circumvent the license key functionality in the software
unlicense; this is free and unencumbered software released into the public domain; anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary
zlib; in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose; the origin of this software must not be misrepresented you must not claim that you wrote the original software; altered source versions must be plainly marked as such and must not be misrepresented as being the original software
libpng; the origin of this source code must not be misrepresented; altered versions must be plainly marked as such and must not be misrepresented as being the original source
curl; permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software
openssl; this product includes software developed by the openssl project for use in the openssl toolkit; the names openssl toolkit and openssl project must not be used to endorse or promote products
ssleay; this library is free for commercial and non commercial use as long as the following conditions are aheared to
python-2.0; psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test perform and or display publicly; psf is making python available to licensee on an as is basis
php-3.01; products derived from this software may not be called php nor may php appear in their name
ruby; you may make and give away verbatim copies of the source form of the software without restriction provided that you duplicate all of the original copyright notices; you may modify your copy of the software in any way provided that you do at least one of the following
vim; there are no restrictions on distributing unmodified copies of vim except that they must include this license text
w3c; permission to copy modify and distribute this work with or without modification for any purpose and without fee or royalty is hereby granted
unicode-3.0; permission is hereby granted free of charge to any person obtaining a copy of data files and any associated documentation
ofl-1.1; this font software is licensed under the sil open font license; no modified version of the font software may use the reserved font name s unless explicit written permission is granted; neither the font software nor any of its individual components in original or modified versions may be sold by itself
eupl; the work is provided under the terms of this licence when the licensor as defined below has placed the following notice
ms-pl; if you use the software you accept this license if you do not accept the license do not use the software; if you bring a patent claim against any contributor over patents that you claim are infringed by the software
ms-rl; for any file you distribute that contains code from the software in source code or binary format you must provide recipients the source code to that file
afl-3.0; licensor hereby grants you a worldwide royalty free non exclusive sublicensable license for the duration of the copyright
qpl-1.0; this license applies to any software containing a notice placed by the copyright holder saying that it may be distributed under the terms of the q public license
sleepycat; redistributions in any form must be accompanied by information on how to obtain complete source code for the software and any accompanying software that uses the software
mulanpsl-2.0; subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide royalty free non exclusive irrevocable copyright license to reproduce use modify or distribute its contribution
lppl-1.3c; this work may be distributed and or modified under the conditions of the latex project public license; this work has the lppl maintenance status
blueoak-1.0.0; each contributor licenses you to do everything with this software that would otherwise infringe that contributor s copyright in it
json; the software shall be used for good not evil
beerware; as long as you retain this notice you can do whatever you want with this stuff if we meet some day and you think this stuff is worth it
wtfpl; everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
odbl-1.0; you are free to share copy distribute and use the database to create produce works from the database to adapt modify transform and build upon the database
odc-by-1.0; you must attribute any public use of the database or works produced from the database
pddl-1.0; the rightsholder permanently and irrevocably makes the work available to the public for any use of any kind
cdla-permissive-2.0; the agreement does not impose any restriction or obligations with respect to the use modification or sharing of results
openrail; you agree not to use the model or derivatives of the model in any way that violates any applicable national federal state local or international law
cc0-1.0; the person who associated a work with this deed has dedicated the work to the public domain; affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders all of affirmer s copyright; to the extent possible under law the|this author|person s? has|have waived all copyright and related or neighboring rights to
cc; by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons; you must give appropriate credit provide a link to the license and indicate if changes were made; you may not apply legal terms or technological measures that legally restrict others from doing anything the license permits
cc-by-sa; if you remix transform or build upon the material you must distribute your contributions under the same license as the original
cc-by-nc; you may not use the material for commercial purposes
cc-by-nd; if you remix transform or build upon the material you may not distribute the modified material
public-domain; the author|authors hereby? disclaims|disclaim copyright to this source code; this work has been released into the public domain by its author; no copyright is claimed in the united states under title 17
proprietary; this software is the confidential and proprietary information of; unauthorized copying of this file via any medium is strictly prohibited; you shall not disclose such confidential information and shall use it only in accordance with the terms of the license agreement; no part of this publication|document|work may be reproduced distributed or transmitted in any form or by any means; this program contains proprietary information and is protected by copyright law; you may not reverse engineer decompile or disassemble the software
warranty-disclaimer; the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement; in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise; any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed
"""

#: Words that are too common in licenses to gate a rule by themselves.
_WEAK = {"license", "version", "public", "the", "and", "software", "general", "source", "open", "free"}
TAG, NOTICE, BODY, NAME = 4, 3, 2, 1
#: Confidence of each level.
SCORE = {TAG: 1.0, NOTICE: 0.95, BODY: 0.9, NAME: 0.8}
_HIT = "struct<first:int,reach:int,rank:int,rule:int,label:string,level:int,last:int>"


def _word(token: str) -> str:
    words = [w.rstrip("?") for w in token.split("|")]
    return f"(?: (?:{'|'.join(words)}) )" + "?" * token.endswith("?")


def _pattern(tokens: list[str]) -> str:
    return "".join(_word(t) for t in tokens)


def _keyword(tokens: list[str]) -> str:
    """The longest word that every hit has, common ones last."""
    plain = [t for t in tokens if "|" not in t and not t.endswith("?")]
    return max([t for t in plain if t not in _WEAK] or plain, key=len)


def rules() -> list[tuple[str, int, str, str, str]]:
    """(label, level, two keywords, pattern) in order: identifier tags, license notices, sentences of license texts, bare names."""
    tags, notices, names = [], [], []
    for line in SIGNATURES.strip().splitlines():
        label, *forms = ([*part.split()] for part in line.split(";"))
        tag, label = forms[0], label[0]
        tags.append((label, TAG, "spdx", "identifier", _pattern(["spdx", "license", "identifier", *tag])))
        for form in forms:
            start = ["licensed|distributed|released|licenced", "under", "the?", "terms?", "of?", "the?"]
            notices.append((label, NOTICE, "under", _keyword(form), _pattern([*start, *form])))
        for form in forms if len(tag) > 1 else forms[1:]:
            names.append((label, NAME, _keyword(form), _keyword(form), _pattern(form)))
    bodies = []
    for line in BODIES.strip().splitlines():
        label, *sentences = ([*part.split()] for part in line.split(";"))
        for words in sentences:
            one, two = sorted({t for t in words if "|" not in t and not t.endswith("?")} - _WEAK, key=lambda t: (-len(t), t))[:2]
            bodies.append((label[0], BODY, one, two, _pattern(words)))
    base = [(label, NAME, _keyword(p.split()), _keyword(p.split()), _pattern(p.split())) for p, label in BASE.items()]
    return list(dict.fromkeys([*tags, *notices, *bodies, *names, *base]))


def keywords() -> list[str]:
    return sorted({k for rule in rules() for k in rule[2:4]})


def _normalized(text: Column) -> Column:
    """Lower-case words, each between two spaces of its own."""
    words = F.trim(F.regexp_replace(lower_ascii(text), GAP, " "))
    return F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(normal: Column, pattern: Column, fields) -> Column:
    """Array of ``fields(first word, last word)`` of the pattern's hits from left to right."""
    gaps = F.transform(F.split(normal, pattern, -1), _spaces)
    sizes = F.arrays_zip(gaps.alias("gap"), F.transform(F.regexp_extract_all(normal, pattern, F.lit(0)), _spaces).alias("hit"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,last:int>>").alias("out"))

    def step(acc, x):
        first = acc["at"] + x["gap"]
        place = F.struct((first / 2).cast("int").alias("first"), ((first + x["hit"]) / 2 - 1).cast("int").alias("last"))
        out = F.when(x["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(place)))
        return F.struct((first + F.coalesce(x["hit"], F.lit(0))).alias("at"), out.alias("out"))

    return F.transform(F.aggregate(sizes, start, step)["out"], lambda p: fields(p["first"], p["last"]))


def _rule_array() -> Column:
    """The rules as one literal, as large as the list and no larger."""
    return F.array(*[
        F.struct(F.lit(k).alias("rule"), F.lit(label).alias("label"), F.lit(level).alias("level"), F.array(F.lit(a), F.lit(b)).alias("keys"), F.lit(pattern).alias("pattern"))
        for k, (label, level, a, b, pattern) in enumerate(rules())
    ])


def _kept(hits: Column) -> Column:
    """Hits that no stronger interval contains.

    In the order first ascending, last descending, level descending, rule, an interval lies in an earlier one exactly
    if the largest ``last`` so far reaches its own. One running maximum for each level suffices.
    """
    levels = sorted(SCORE)
    start = F.struct(*[F.lit(-1).alias(f"to{n}") for n in levels], F.array().cast(f"array<{_HIT}>").alias("out"))

    def step(acc, x):
        covered = F.lit(False)
        for n in levels:
            covered = covered | ((x["level"] <= n) & (acc[f"to{n}"] >= x["last"]))
        reach = [F.when(x["level"] == n, F.greatest(x["last"], acc[f"to{n}"])).otherwise(acc[f"to{n}"]).alias(f"to{n}") for n in levels]
        return F.struct(*reach, F.when(covered, acc["out"]).otherwise(F.concat(acc["out"], F.array(x))).alias("out"))

    return F.aggregate(F.array_sort(hits), start, step)["out"]


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus struct column ``license_scan``: ``n_words``; ``base``, the places of the base phrases (label, first,
    last word); ``hits``, what the rules leave after suppression (label, level, rule, first, last word)."""
    body = F.coalesce(F.col(text), F.lit(""))
    # lower() differs from A-Z alone only beyond ASCII, where it makes no keyword and no gap
    words = docs.select("*", F.split(F.lower(body), GAP, -1).alias("__words"))
    w = F.col("__words")
    n_words = F.size(w) - (w[0] == "").cast("int") - ((F.size(w) > 1) & (F.element_at(w, -1) == "")).cast("int")
    gated = words.select(
        *docs.columns, n_words.cast("long").alias("__n"), F.array_intersect(w, F.array(*[F.lit(k) for k in keywords()])).alias("__keys")
    )
    keys = F.col("__keys")
    normal = gated.select("*", F.when(F.size(keys) > 0, _normalized(body)).alias("__normal"))
    normal_text = F.col("__normal")

    def hit(rule):
        return _places(normal_text, rule["pattern"], lambda first, last: F.struct(
            first.alias("first"), (-last).alias("reach"), (-rule["level"]).alias("rank"), rule["rule"].alias("rule"),
            rule["label"].alias("label"), rule["level"].alias("level"), last.alias("last")))

    open_rules = F.filter(_rule_array(), lambda rule: F.size(F.array_except(rule["keys"], keys)) == 0)
    hits = F.when(F.size(keys) > 0, _kept(F.flatten(F.transform(open_rules, hit)))).otherwise(F.array().cast(f"array<{_HIT}>"))
    base = F.concat(*[
        F.when(F.array_contains(keys, _keyword(p.split())), _places(normal_text, F.lit(_pattern(p.split())), lambda first, last, label=label: F.struct(
            F.lit(label).alias("label"), first.alias("first"), last.alias("last"))))
        .otherwise(F.array().cast("array<struct<label:string,first:int,last:int>>"))
        for p, label in BASE.items()
    ])
    out = F.struct(F.col("__n").alias("n_words"), base.alias("base"), F.transform(
        hits, lambda h: F.struct(h["label"].alias("label"), h["level"].alias("level"), h["rule"].alias("rule"), h["first"].alias("first"), h["last"].alias("last"))).alias("hits"))
    return normal.select(*docs.columns, out.alias("license_scan"))


def digest(scanned: DataFrame, identifier: str = "doc_id") -> DataFrame:
    """One row of figures for each row of ``scan``."""
    base, hits = F.col("license_scan.base"), F.col("license_scan.hits")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.array_max(hits["level"])
    score = F.coalesce(*[F.when(best == level, F.lit(value)) for level, value in SCORE.items()], F.lit(0.0))
    return scanned.select(
        identifier,
        F.col("license_scan.n_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["first"]).cast("long").alias("first_word"),
        F.array_max(base["first"]).cast("long").alias("last_word"),
        joined(base["label"]).alias("base_labels"),
        joined(F.concat(base["label"], hits["label"])).alias("labels"),
        score.alias("score"),
    )
