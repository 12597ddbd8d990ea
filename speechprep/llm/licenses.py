"""Operator 4: licence scan with ordered signature rules.

Every rule is a regular expression with a label, a priority, a confidence and
a keyword.  First come signatures written for one licence each: sentences of
its title, grant, conditions and disclaimer, and wordings of dual licences and
exceptions.  Below them stand identifiers, addresses and general sentence forms,
one for each family of names.  A text is read once for the anchor words; only a
text with an anchor is lower-cased and checked for keywords, and only rules
whose keyword occurs run.  Overlaps are resolved by interval containment: in
order of start (longest first), a detection inside another of the same or higher
priority is suppressed.

Rules match over line breaks and comment boxes: comment marks that follow white
space are replaced, one for one, by a filler, so places keep and a gap between
two words may be of any length.

Beside the method's detections stand the base phrases, which are found on
words and never suppressed.

Defined cases: null and empty texts have no words, no places and score 0;
texts are read whole; every input row gives one row; an empty table an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, matches, pick, running_max, table

#: Between words: everything ASCII that is neither digit nor letter.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
BASE = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}


@dataclass(frozen=True)
class Family:
    label: str
    name: str  # regex of the licence's name, lower case
    keyword: str  # literals joined by |, one of which is in every name, identifier and address
    spdx: str  # regex of its SPDX identifiers, lower case
    url: str = ""


FAMILIES = (
    Family("mit", r"(?:mit|expat|x11)", "mit|expat|x11", r"mit(?:-0)?", r"opensource\.org/licenses?/mit"),
    Family("apache", r"apache(?: software)?", "apache", r"apache-[12]\.[01]", r"(?:www\.)?apache\.org/licenses/license-[12]\.[01]"),
    Family("gpl", r"(?:gnu )?(?:general public|gpl)", "general public|gpl", r"gpl-[123]\.0(?:-only|-or-later|\+)?", r"(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?gpl"),
    Family("lgpl", r"(?:gnu )?(?:(?:lesser|library) general public|lgpl)", "lesser general|library general|lgpl", r"lgpl-[23]\.[01](?:-only|-or-later|\+)?", r"(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?lgpl"),
    Family("agpl", r"(?:gnu )?(?:affero general public|agpl)", "affero|agpl", r"agpl-[13]\.0(?:-only|-or-later|\+)?", r"(?:www\.)?gnu\.org/licenses/agpl"),
    Family("gfdl", r"(?:gnu )?(?:free documentation|gfdl)", "free documentation|gfdl", r"gfdl-1\.[123](?:-only|-or-later)?", r"(?:www\.)?gnu\.org/licenses/fdl"),
    Family("bsd", r"(?:(?:simplified|modified|revised|new|[0234][- ]clause) )?bsd", "bsd", r"bsd-[0-4]-clause(?:-[a-z]{1,12})?|0bsd", r"opensource\.org/licenses?/bsd"),
    Family("isc", r"isc", "isc", r"isc", r"opensource\.org/licenses?/isc"),
    Family("mpl", r"(?:mozilla public|mpl)", "mozilla|mpl", r"mpl-[12]\.[01]", r"(?:www\.)?mozilla\.org/(?:en-us/)?mpl"),
    Family("epl", r"(?:eclipse public|epl)", "eclipse|epl", r"epl-[12]\.0", r"(?:www\.)?eclipse\.org/legal/epl"),
    Family("cddl", r"(?:common development and distribution|cddl)", "common development|cddl", r"cddl-1\.[01]"),
    Family("cpl", r"common public", "common public|cpl", r"cpl-1\.0"),
    Family("cc0", r"(?:creative commons zero|cc0)", "creative commons zero|cc0|/zero", r"cc0-1\.0", r"creativecommons\.org/publicdomain/zero"),
    Family("cc-by", r"(?:cc[- ]by|creative commons attribution)", "cc by|cc-by|attribution|/by/", r"cc-by-[1-4]\.[05]", r"creativecommons\.org/licenses/by/"),
    Family("cc-by-sa", r"(?:cc[- ]by[- ]sa|creative commons attribution[- ]sharealike)", "by sa|by-sa|sharealike", r"cc-by-sa-[1-4]\.[05]", r"creativecommons\.org/licenses/by-sa/"),
    Family("cc-by-nc", r"(?:cc[- ]by[- ]nc|creative commons attribution[- ]noncommercial)", "by nc|by-nc|noncommercial", r"cc-by-nc-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nc/"),
    Family("cc-by-nd", r"(?:cc[- ]by[- ]nd|creative commons attribution[- ]noderiv(?:ative)?s)", "by nd|by-nd|noderiv", r"cc-by-nd-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nd/"),
    Family("cc-by-nc-sa", r"(?:cc[- ]by[- ]nc[- ]sa|creative commons attribution[- ]noncommercial[- ]sharealike)", "nc sa|nc-sa|sharealike", r"cc-by-nc-sa-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nc-sa/"),
    Family("cc-by-nc-nd", r"(?:cc[- ]by[- ]nc[- ]nd|creative commons attribution[- ]noncommercial[- ]noderiv(?:ative)?s)", "nc nd|nc-nd|noderiv", r"cc-by-nc-nd-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nc-nd/"),
    Family("unlicense", r"unlicense", "unlicense", r"unlicense", r"unlicense\.org"),
    Family("zlib", r"(?:zlib|zlib/libpng)", "zlib", r"zlib(?:-acknowledgement)?", r"(?:www\.)?zlib\.net/zlib_license"),
    Family("boost", r"boost(?: software)?", "boost|bsl-", r"bsl-1\.0", r"(?:www\.)?boost\.org/license_1_0"),
    Family("artistic", r"artistic", "artistic", r"artistic-[12]\.0(?:-perl|-cl8)?"),
    Family("wtfpl", r"(?:wtfpl|do what the fuck you want to public)", "wtfpl|want to public", r"wtfpl", r"(?:www\.)?wtfpl\.net"),
    Family("eupl", r"(?:european union public|eupl)", "european union|eupl", r"eupl-1\.[012]"),
    Family("ofl", r"(?:sil )?(?:open font|ofl)", "open font|ofl", r"ofl-1\.[01](?:-rfn|-no-rfn)?", r"scripts\.sil\.org/ofl"),
    Family("ms-pl", r"(?:microsoft public|ms-pl)", "microsoft public|ms-pl", r"ms-pl"),
    Family("ms-rl", r"(?:microsoft reciprocal|ms-rl)", "microsoft reciprocal|ms-rl", r"ms-rl"),
    Family("psf", r"(?:python software foundation|psf)", "python|psf", r"psf-2\.0|python-2\.0"),
    Family("postgresql", r"postgresql", "postgresql", r"postgresql"),
    Family("openssl", r"openssl", "openssl", r"openssl"),
    Family("php", r"php", "php", r"php-3\.0[01]?"),
    Family("ruby", r"ruby", "ruby", r"ruby"),
    Family("vim", r"vim", "vim", r"vim"),
    Family("w3c", r"w3c(?: software(?: and document)?)?", "w3c", r"w3c(?:-[0-9]{4,8})?"),
    Family("ncsa", r"(?:university of illinois/)?ncsa(?: open source)?", "ncsa", r"ncsa"),
    Family("afl", r"academic free", "academic free|afl-", r"afl-[123]\.[012]"),
    Family("osl", r"open software", "open software|osl-", r"osl-[123]\.[01]"),
    Family("ecl", r"educational community", "educational|ecl-", r"ecl-[12]\.0"),
    Family("odbl", r"(?:open (?:data commons open )?database|odbl)", "database|odbl", r"odbl-1\.0", r"opendatacommons\.org/licenses/odbl"),
    Family("pddl", r"(?:public domain dedication and|pddl)", "dedication|pddl", r"pddl-1\.0"),
    Family("cecill", r"cecill(?:-[bc])?", "cecill", r"cecill-(?:[12]\.[01]|[bc])"),
    Family("sleepycat", r"sleepycat", "sleepycat", r"sleepycat"),
    Family("zpl", r"zope public", "zope|zpl-", r"zpl-[12]\.[01]"),
    Family("curl", r"curl", "curl", r"curl"),
    Family("beerware", r"beer[- ]?ware", "beer", r"beerware"),
    Family("sspl", r"(?:server side public|sspl)", "server side|sspl", r"sspl-1\.0"),
    Family("busl", r"business source", "business source|busl", r"busl-1\.1"),
)

#: Sentence forms: (anchor, priority, confidence, regex with NAME and SPDX).
_GRANT = r"(?:licen[sc]ed|released|distributed|available|published|provided|covered|redistributed)"
_VERSION = r"(?:,? (?:version|v\.?) ?[0-9](?:\.[0-9])?| [0-9]\.[0-9])?"
FORMS = (
    ("spdx", 5, 1.0, r"\bspdx-license-identifier:[ \t]{0,4}\(?(?:SPDX)(?![a-z0-9.-])"),
    ("licen", 4, 0.95, rf"\b{_GRANT} under (?:the )?(?:terms of (?:the )?)?NAME(?: public)?(?: licen[sc]es?)?\b{_VERSION}"),
    ("licen", 4, 0.9, r"\blicen[sc]es?[ \t]{0,4}[:=][ \t]{0,4}['\"]?(?:the )?NAME(?![a-z0-9])"),
    ("licen", 3, 0.85, rf"\bNAME licen[sc]e(?:,? (?:version|v\.?) ?[0-9](?:\.[0-9])?| [0-9]\.[0-9])"),
    ("licen", 3, 0.8, r"\b(?:subject to|under|see|of|by|accept) the (?:terms of the )?NAME licen[sc]e\b"),
    ("licen", 2, 0.7, r"\bNAME[ -]licen[sc]e\b"),
    ("licen", 1, 0.5, r"\blicen[sc]ed?\b[^.\n]{0,40}\bNAME(?![a-z0-9])"),
)
_FREE = (  # rules that belong to no family form: (label, anchor, keyword, priority, confidence, regex)
    ("public-domain", "public domain", "domain", 3, 0.9, r"\b(?:released|dedicated|placed) (?:in|in ?to|to) the public domain\b"),
    ("public-domain", "public domain", "domain", 1, 0.5, r"\bpublic domain\b"),
    ("proprietary", "all rights reserved", "reserved", 2, 0.6, r"\ball rights reserved\b"),
    ("proprietary", "licen", "proprietary", 3, 0.8, r"\bproprietary (?:software )?licen[sc]e\b"),
    ("proprietary", "licen", "commercial", 2, 0.6, r"\bcommercial licen[sc]e\b"),
    ("mit", "hereby granted", "permission", 4, 0.95, r"\bpermission is hereby granted, free of charge, to any person obtaining a copy\b"),
    ("isc", "permission to use", "permission", 4, 0.9, r"\bpermission to use, copy, modify, and/or distribute this software for any purpose\b"),
    ("bsd", "redistribution", "binary", 4, 0.95, r"\bredistribution and use in source and binary forms\b"),
    ("gpl", "licen", "gnu", 4, 0.95, r"\bunder the terms of the gnu general public license as published by the free software foundation\b"),
    ("unlicense", "public domain", "unencumbered", 4, 0.95, r"\bthis is free and unencumbered software released into the public domain\b"),
)
#: Signatures of single licences (fixed values: wordings of their texts), as
#: (label, confidence, regex in lower case).
SIGNATURES = (
    # mit, x11, mit-0
    ("mit", 1.0, r"\bto deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish"),
    ("mit", 0.95, r"\bthe above copyright notice and this permission notice (?:\([a-z ]+\) )?shall be included in all copies or substantial portions of the software\b"),
    ("mit", 0.8, r"\bfitness for a particular purpose and noninfringement\b"),
    ("mit", 0.8, r"\bin no event shall the authors or copyright holders be liable for any claim, damages or other liability\b"),
    ("mit", 0.95, r"\bexcept as contained in this notice, the name of the x consortium shall not be used\b"),
    ("mit", 0.95, r"\bthe mit license \(mit\)"),
    ("mit", 0.95, r"\bmit no attribution\b"),
    # bsd
    ("bsd", 1.0, r"\bredistributions of source code must retain the (?:above )?copyright notice, this list of conditions and the following disclaimer\b"),
    ("bsd", 1.0, r"\bredistributions in binary form must reproduce the (?:above )?copyright notice, this list of conditions and the following disclaimer in the documentation\b"),
    ("bsd", 0.95, r"\bneither the names? of (?:\S++ ){1,20}?nor the names of (?:its|their|other) contributors may be used to endorse or promote products\b"),
    ("bsd", 0.9, r"\bprovided by the copyright holders and contributors \\?[\"'`]{0,2}as is\\?[\"'`]{0,2} and any express or implied warranties\b"),
    ("bsd", 0.9, r"\bprovided by the regents and contributors\b"),
    ("bsd", 0.95, r"\ball advertising materials mentioning features or use of this software must display the following acknowledge?ment\b"),
    ("bsd", 0.9, r"\bneither the name of the university nor the names of its contributors\b"),
    ("bsd", 0.7, r"\bpermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted\.(?! provided)"),
    # isc and kin
    ("isc", 0.95, r"\bdistribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies\b"),
    ("isc", 0.85, r"\bthe author disclaims all warranties with regard to this software including all implied warranties\b"),
    ("isc", 0.8, r"\bwhether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software\b"),
    ("ntp", 0.9, r"\bthat both (?:the|that) copyright notice and this permission notice appear in supporting documentation\b"),
    ("hpnd", 0.9, r"\bnot be used in advertising or publicity pertaining to distribution of the software without specific,? (?:written )?prior permission\b"),
    # apache
    ("apache", 1.0, r"\blicensed under the apache license, version 2\.0 \(the [\"'`]{0,2}license[\"'`]{0,2}\)"),
    ("apache", 0.9, r"\byou may not use this file except in compliance with the license\b"),
    ("apache", 0.9, r"\bsee the license for the specific language governing permissions and limitations under the license\b"),
    ("apache", 0.95, r"\blicensed to the apache software foundation \(asf\) under one or more contributor license agreements\b"),
    ("apache", 0.95, r"\bthe asf licenses this file to you under the apache license\b"),
    ("apache", 0.9, r"\bthis product includes software developed by the apache software foundation\b"),
    ("apache", 0.95, r"\bgrant of patent license\. subject to the terms and conditions of this license, each contributor hereby grants to you\b"),
    ("apache", 0.95, r"\bapache license version 2\.0, january 2004\b"),
    # gpl, lgpl, agpl, gfdl
    ("gpl", 0.95, r"\byou can redistribute it and/or modify it under the terms of the gnu general public license\b"),
    ("gpl", 0.9, r"\beither version [123](?:\.0)? of the license, or \(at your option\) any later version\b"),
    ("gpl", 0.95, r"\byou should have received a copy of the gnu general public license along with this program\b"),
    ("gpl", 0.95, r"\bsee the gnu general public license for more details\b"),
    ("gpl", 0.6, r"\bwithout even the implied warranty of merchantability or fitness for a particular purpose\b"),
    ("gpl", 0.95, r"\bthe licenses for most software are designed to take away your freedom to share and change it\b"),
    ("gpl", 0.95, r"\bthe gnu general public license is a free, copyleft license for software and other kinds of works\b"),
    ("gpl", 0.9, r"\bas published by the free software foundation; version 2 of the license\b"),
    ("gpl", 0.9, r"\bgnu general public license,? version [123](?:\.0)?(?: only| or later)?\b"),
    ("gpl-linking-exception", 0.9, r"\bgcc runtime library exception|\bgnu classpath exception|\bgeneral public license with (?:the )?(?:classpath|linking|runtime library) exception\b"),
    ("gpl-linking-exception", 0.95, r"\bpermission to link (?:this library|the code of portions of this program|the program) with (?:independent modules to produce an executable|the openssl library)"),
    ("gpl-linking-exception", 0.9, r"\bas a special exception, the copyright holders (?:of this library )?give you permission to\b"),
    ("gpl", 0.9, r"\bthis copyright does \*?not\*? cover user programs that use kernel services by normal system calls\b"),
    ("lgpl", 0.95, r"\bredistribute it and/or modify it under the terms of the gnu (?:lesser|library) general public license\b"),
    ("lgpl", 0.95, r"\breceived a copy of the gnu lesser general public license along with this (?:library|program)\b"),
    ("lgpl", 0.95, r"\bsee the gnu (?:lesser|library) general public license for more details\b"),
    ("lgpl", 0.9, r"\ba program that contains no derivative of any portion of the library, but is designed to work with the library\b"),
    ("lgpl", 0.9, r"\blesser general public license with (?:a )?static[- ]linking exception\b"),
    ("agpl", 0.95, r"\bredistribute it and/or modify it under the terms of the gnu affero general public license\b"),
    ("agpl", 0.95, r"\breceived a copy of the gnu affero general public license along with this program\b"),
    ("agpl", 0.95, r"\ball users interacting with it remotely through a computer network\b"),
    ("gfdl", 0.95, r"\bpermission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license\b"),
    ("gfdl", 0.9, r"\bwith no invariant sections, no front-cover texts,? and no back-cover texts\b"),
    # mozilla, eclipse and kin
    ("mpl", 1.0, r"\bthis source code form is subject to the terms of the mozilla public license, v\. 2\.0\b"),
    ("mpl", 0.95, r"\bthe contents of this file are subject to the mozilla public license version 1\.[01]\b"),
    ("mpl", 0.95, r"\bif a copy of the mpl was not distributed with this file\b"),
    ("mpl", 0.95, r"\bincompatible with secondary licenses, as defined by the mozilla public license\b"),
    ("epl", 1.0, r"\bthis program and the accompanying materials are made available under the terms of the eclipse public license\b"),
    ("epl", 0.95, r"\bthe accompanying program is provided under the terms of this eclipse public license\b"),
    ("cpl", 0.95, r"\bthe accompanying program is provided under the terms of this common public license\b"),
    ("ipl", 0.95, r"\bibm public license version 1\.0\b"),
    ("cddl", 0.95, r"\bthe contents of this file are subject to the terms of the common development and distribution license\b"),
    ("cddl", 0.9, r"\bwhen distributing covered code, include this cddl header in each file\b"),
    ("spl", 0.95, r"\bsubject to the sun public license version 1\.0\b"),
    ("apsl", 0.95, r"\bsubject to the apple public source license\b|\bapple public source license,? version [12]\.[012]\b"),
    ("npl", 0.95, r"\bsubject to the netscape public license\b"),
    ("qpl", 0.95, r"\bq public license version 1\.0\b|\bunder the terms of the q public license\b"),
    ("cpal", 0.95, r"\bcommon public attribution license version 1\.0\b"),
    ("rpl", 0.95, r"\breciprocal public license,? version 1\.[15]\b"),
    ("nasa", 0.95, r"\bnasa open source agreement version 1\.3\b"),
    ("upl", 0.95, r"\bthe universal permissive license \(upl\), version 1\.0\b"),
    ("eupl", 0.95, r"\blicensed under the eupl,? version 1\.[012]\b|\beuropean union public licen[cs]e v(?:ersion|\.)? ?1\.[012]\b"),
    # creative commons and data
    ("cc0", 1.0, r"\bhas waived all copyright and related or neighboring rights\b|\bto the extent possible under law, (?:\S++ ){1,20}?has waived all copyright\b"),
    ("cc0", 0.9, r"\baffirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives\b"),
    ("cc-by", 0.95, r"\bcreative commons attribution 4\.0 international(?: public)? license\b"),
    ("cc-by-sa", 0.95, r"\bcreative commons attribution-share ?alike [1-4]\.0 (?:international|unported|generic)(?: public)? license\b"),
    ("cc-by-nc", 0.95, r"\bcreative commons attribution-non ?commercial [1-4]\.0 (?:international|unported|generic)(?: public)? license\b"),
    ("cc-by-nd", 0.95, r"\bcreative commons attribution-no ?derivatives [1-4]\.0 (?:international|unported|generic)(?: public)? license\b"),
    ("cc-by-nc-sa", 0.95, r"\bcreative commons attribution-non ?commercial-share ?alike [1-4]\.0 (?:international|unported|generic)(?: public)? license\b"),
    ("cc-by-nc-nd", 0.95, r"\bcreative commons attribution-non ?commercial-no ?derivatives [1-4]\.0 (?:international|unported|generic)(?: public)? license\b"),
    ("odbl", 0.95, r"\bmade available under the open database license\b"),
    ("odc-by", 0.95, r"\bopen data commons attribution license\b"),
    ("pddl", 0.95, r"\bopen data commons public domain dedication (?:&|and) licen[cs]e\b"),
    ("cdla", 0.95, r"\bcommunity data license agreement ?[-–]{0,2} ?(?:permissive|sharing)\b"),
    # public domain
    ("unlicense", 1.0, r"\banyone is free to copy, modify, publish, use, compile, sell, or distribute this software\b"),
    ("unlicense", 0.95, r"\bto the detriment of our heirs and successors\b"),
    ("public-domain", 0.95, r"\bthe author disclaims copyright to this source code\b"),
    ("public-domain", 0.9, r"\b(?:is a|as a) work of the (?:united states|u\.s\.) government\S*+ (?:\S++ ){0,20}?public domain\b"),
    ("public-domain", 0.8, r"\bno rights reserved\b"),
    ("0bsd", 0.95, r"\bzero[- ]clause bsd\b|\bbsd zero clause license\b"),
    # zlib, boost and other short ones
    ("zlib", 0.95, r"\bthis software is provided '?as-is'?, without any express or implied warranty\b"),
    ("zlib", 0.95, r"\bthe origin of this software must not be misrepresented; you must not claim that you wrote the original software\b"),
    ("zlib", 0.9, r"\baltered source versions must be plainly marked as such\b"),
    ("libpng", 0.95, r"\bpng reference library license version 2\b"),
    ("boost", 0.95, r"\bdistributed under the boost software license, version 1\.0\b"),
    ("boost", 0.95, r"\bto any person or organization obtaining a copy of the software and accompanying documentation covered by this license\b"),
    ("artistic", 0.95, r"\byou may distribute (?:it|them) under the terms of either the gnu general public license or the artistic license\b"),
    ("artistic", 0.95, r"\bsuch that the copyright holder maintains some semblance of artistic control\b"),
    ("perl", 0.95, r"\bunder the same terms as (?:the )?perl(?: 5)?(?: programming language system)? itself\b"),
    ("wtfpl", 1.0, r"\byou just do what the fuck you want to\b"),
    ("beerware", 0.95, r"\byou can buy me a beer in return\b|\bas long as you retain this notice you can do whatever you want with this stuff\b"),
    ("ncsa", 0.9, r"\buniversity of illinois/ncsa open source license\b"),
    ("ofl", 0.95, r"\bthis font software is licensed under the sil open font license, version 1\.1\b|\bwith reserved font name\b"),
    ("openssl", 0.95, r"\bthis product includes software developed by the openssl project\b"),
    ("ssleay", 0.95, r"\bthis product includes cryptographic software written by eric young\b"),
    ("php", 0.95, r"\bthis source file is subject to version [23]\.0[01]? of the php license\b"),
    ("psf", 0.95, r"\bpython software foundation license version 2\b|\bpsf license agreement for python\b"),
    ("ruby", 0.9, r"\byou can redistribute it and/or modify it under (?:either the terms of the 2-clause bsdl|the same terms as ruby)\b"),
    ("postgresql", 0.9, r"\bpermission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted\b"),
    ("tcl", 0.85, r"\bthe authors hereby grant permission to use, copy, modify, distribute, and license this software and its documentation for any purpose\b"),
    ("w3c", 0.95, r"\bw3c(?:\(r\)|®)? software (?:notice and license|and document notice and license)\b"),
    ("unicode", 0.9, r"\bunicode(?:, inc\.)? license agreement\b|\bany person obtaining a copy of the unicode data files\b"),
    ("icu", 0.9, r"\bicu license ?[-–] ?icu 1\.8\.1 and later\b"),
    ("ms-pl", 0.95, r"\bsubject to the microsoft public license\b"),
    ("sspl", 0.95, r"\bunder the terms of the server side public license, version 1\b"),
    ("elastic", 0.95, r"\belastic license 2\.0\b|\bsubject to the elastic license\b"),
    ("busl", 0.9, r"\bbusiness source license 1\.1\b"),
    ("commons-clause", 0.95, r"\bcommons clause[\"”']? license condition\b|\bdoes not grant to you,? the right to sell the software\b"),
    ("polyform", 0.95, r"\bpolyform (?:noncommercial|small business|shield|perimeter|strict|internal use) license\b"),
    ("json", 1.0, r"\bthe software shall be used for good, not evil\b"),
    ("cecill", 0.95, r"\bgoverned by the cecill(?:-[bc])? license under french law\b"),
    ("openrail", 0.95, r"\b(?:bigscience|creativeml) open ?rail(?:-m)? license\b"),
    # several licences, and none
    ("dual", 0.9, r"\bdual[- ]licensed under\b|\bthis (?:work|project|software|crate) is dual[- ]licensed\b"),
    ("dual", 0.85, r"\blicensed under either of (?:\S++ ){1,40}?at your option\b"),
    ("dual", 0.85, r"\balternatively, (?:this (?:file|software|work)|the contents of this file) may be (?:distributed|used|licensed) under the terms of\b"),
    ("proprietary", 0.9, r"\bconfidential and proprietary\b"),
    ("proprietary", 0.9, r"\bunpublished proprietary source code\b|\bcontains trade secrets?\b"),
    ("proprietary", 0.9, r"\bend[- ]user licen[cs]e agreement\b"),
    ("proprietary", 0.8, r"\bwithout (?:the )?(?:express )?(?:prior )?written permission\b"),
    ("proprietary", 0.85, r"\bnon-?exclusive, non-?transferable,? (?:limited |revocable )?licen[cs]e\b"),
)
#: Between the words of a rule: white space of any length, with fillers.
FILL = "\ue003"
GAP = rf"(?:\s[\s{FILL}]*+)"
#: Comment marks after white space, or after other such marks.
_MARKS = r"(?:(?<=\s)|(?!\A)\G)[*#/;%!>-]"
ANCHORS = ("licen", "spdx", "public domain", "all rights reserved", "hereby granted", "permission to use",
           "redistribution", "://", "")


#: A word of each anchor; a text without any of them is not read further.
_GATE = ("licen", "spdx", "domain", "reserved", "hereby", "permission", "redistribut", "://", "warrant", "software", "copyright",
         "attribution", "contributors", "notice", "distribut", "heirs", "affirmer", "unicode", "proprietary", "agreement",
         "exception", "fitness", "derivative", "interacting", "invariant", "altered", "clause", "perl", "fuck", "beer",
         "alternatively", "secret")


def _wrapped(rx: str) -> str:
    """A rule that also matches where lines are broken or commented: every
    blank outside of brackets, and in ``[- ]``, stands for a gap."""
    rx = rx.replace("[- ]", "(?:-| )").replace("[ -]", "(?:-| )").replace(r"[ \t]{0,4}", rf"(?:[ \t][\s{FILL}]*+)?+")
    return "".join(p if p[0] == "[" else p.replace(" ", GAP) for p in re.findall(r"\[(?:\\.|[^\]\\])*\]|(?:\\.|[^\[\\])+", rx))


def runs(rx: str) -> list[list[str]]:
    """For each alternative of a signature the texts that all its matches
    contain (blanks between words being plain)."""
    rx = re.sub(r"\\b|\(\?![^)]*\)", "", rx)
    group = re.compile(r"\((?:\?:)?((?:[^()\\|]|\\.)*)(\|(?:[^()\\]|\\.)*)?\)(\{[^}]*\}|[?*+])?")
    while (less := group.sub(lambda m: "\0" if m[2] or m[3] or m[0].endswith("\\)") else m[1], rx)) != rx:
        rx = less
    loose = re.compile(r"\[(?:[^\]\\]|\\.)*\](?:\{[^}]*\}|[?*+])?\??|\.\{[^}]*\}\??|\\?.(?:[?*]|\{[^}]*\})|[^\x00-\x7f]")
    parts = [loose.sub("\0", part) for part in re.split(r"(?<!\\)\|", rx)]
    return [[re.sub(r"\\(.)", r"\1", x).strip() for x in part.split("\0")] for part in parts]


def literals(rx: str) -> list[str]:
    """The longest such text of each alternative."""
    return [max(found, key=len) for found in runs(rx)]


def rules() -> list[dict]:
    """All signature rules in order of priority."""
    out = [{"label": label, "anchor": "", "keyword": "|".join(literals(rx)), "priority": 6, "confidence": conf, "regex": rx}
           for label, conf, rx in SIGNATURES]
    for f in FAMILIES:
        for anchor, priority, conf, form in FORMS:
            rx = form.replace("NAME", f"(?:{f.name})").replace("SPDX", f.spdx)
            out.append({"label": f.label, "anchor": anchor, "keyword": f.keyword, "priority": priority, "confidence": conf, "regex": rx})
        if f.url:
            out.append({"label": f.label, "anchor": "://", "keyword": "://", "priority": 4, "confidence": 0.9, "regex": f"://{f.url}"})
    for label, anchor, keyword, priority, conf, rx in _FREE:
        out.append({"label": label, "anchor": anchor, "keyword": keyword, "priority": priority, "confidence": conf, "regex": rx})
    return sorted(({**r, "regex": _wrapped(r["regex"])} for r in out), key=lambda r: -r["priority"])


_RULE = "struct<label:string,priority:int,confidence:double,regex:string>"
_DETECTION = "array<struct<start:bigint,neg_end:bigint,neg_priority:int,label:string,confidence:double>>"


def _rule_table(rule_list: list[dict]) -> Column:
    """The rules as one constant: array of (anchor, keyword, rules)."""
    import json

    by: dict[tuple[str, str], list] = {}
    for r in rule_list:
        by.setdefault((r["anchor"], r["keyword"]), []).append({k: r[k] for k in ("label", "priority", "confidence", "regex")})
    groups = [{"anchor": a, "keywords": k.split("|"), "rules": v} for (a, k), v in by.items()]
    return F.from_json(F.lit(json.dumps(groups)), f"array<struct<anchor:string,keywords:array<string>,rules:array<{_RULE}>>>")


def detect(text: Column, rule_list: list[dict] | None = None) -> Column:
    """Detections in a lower-cased ``text`` after suppression, by start."""
    return let(F.regexp_replace(text, _MARKS, FILL), lambda plain: _detect(plain, rule_list or rules()))


def _detect(text: Column, rule_list: list[dict]) -> Column:
    # anchors and keywords of several words are looked for with plain blanks between them
    groups = let(F.regexp_replace(text, GAP, " "), lambda flat: F.filter(
        _rule_table(rule_list),
        lambda g: F.contains(flat, g["anchor"]) & F.exists(g["keywords"], lambda k: F.contains(flat, k)),
    ))

    def found(rule: Column) -> Column:
        return F.transform(
            matches(text, rule["regex"], 0),
            lambda m: F.struct(
                m["start"].alias("start"), (-m["end"]).alias("neg_end"), (-rule["priority"]).alias("neg_priority"),
                rule["label"].alias("label"), rule["confidence"].alias("confidence"),
            ),
        )

    every = F.sort_array(F.flatten(F.transform(groups, lambda g: F.flatten(F.transform(g["rules"], found)))))
    return let(every, _suppress)


PRIORITIES = 6


def _suppress(every: Column) -> Column:
    """Drop a detection that lies inside an earlier one (start order, longest
    first) of the same or higher priority: for each priority, running maxima
    tell how far the detections before of at least that priority reach."""
    reach = F.struct(*[
        running_max(F.transform(every, lambda x: F.when(-x["neg_priority"] >= k, -x["neg_end"]).otherwise(-1))).alias(f"p{k}")  # noqa: B023
        for k in range(1, PRIORITIES + 1)])

    def kept(r: Column) -> Column:
        def free(x: Column, i: Column) -> Column:
            far = F.coalesce(*[F.when(-x["neg_priority"] == k, F.get(r[f"p{k}"], i - 1)) for k in range(1, PRIORITIES + 1)], F.lit(-1))
            return far < -x["neg_end"]

        return F.filter(every, free)

    return F.when(F.size(every) < 2, every).otherwise(let(reach, kept))


def scan(docs: DataFrame, rule_list: list[dict] | None = None) -> DataFrame:
    """One row per input row: doc_id, n_words, base phrase places and labels,
    all labels, score and the kept detections (label, start, end, confidence;
    code points)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = pick(docs, "doc_id", "text").select("doc_id", text.alias("text"))
    d = d.withColumn("words", F.split("text", BREAK + "+"))
    d = d.withColumn(
        "n_words",
        (F.size("words") - F.when(F.get("words", F.lit(0)) == "", 1).otherwise(0)
         - F.when((F.size("words") > 1) & (F.get("words", F.size("words") - 1) == ""), 1).otherwise(0)).cast("long"),
    )
    folded = F.lower("text")
    gate = F.lit(False)
    for a in _GATE:
        gate = gate | F.contains(folded, F.lit(a))
    d = d.withColumn("low", F.when(gate, ascii_lower(F.col("text"))))

    lowered = F.transform(F.array_remove("words", ""), ascii_lower)

    def places(words: Column) -> Column:
        spots = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i) == "license")

        def named(i: Column) -> Column:
            label = F.when(F.get(words, i - 1) == "mit", "mit").when(F.get(words, i - 1) == "apache", "apache").when(
                (F.get(words, i - 1) == "public") & (F.get(words, i - 2) == "general"), "gpl")
            back = F.when(label == "gpl", 2).otherwise(1)
            return F.struct((i - back).cast("long").alias("at"), label.alias("label"))

        return F.filter(F.transform(spots, named), lambda x: x["label"].isNotNull())

    none = F.expr("CAST(array() AS array<struct<at:bigint,label:string>>)")
    has_phrase = F.contains(F.col("low"), F.lit("license")) & (F.col("n_words") > 0)
    d = d.withColumn("base", F.when(has_phrase, let(lowered, places)).otherwise(none))
    d = d.withColumn("found", F.when(F.col("low").isNotNull(), detect(F.col("low"), rule_list)).otherwise(F.expr(f"CAST(array() AS {_DETECTION})")))
    at = F.transform("base", lambda x: x["at"])
    base_labels = F.sort_array(F.array_distinct(F.transform("base", lambda x: x["label"])))
    labels = F.sort_array(F.array_distinct(F.concat(F.transform("base", lambda x: x["label"]), F.transform("found", lambda x: x["label"]))))
    best = F.coalesce(F.array_max(F.transform("found", lambda x: x["confidence"])), F.lit(0.0))
    return d.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(best, F.when(F.size("base") > 0, 0.7).otherwise(0.0)).alias("score"),
        F.transform("found", lambda x: F.struct(
            x["label"].alias("label"), x["start"].alias("start"), (-x["neg_end"]).alias("end"), x["confidence"].alias("confidence"),
        )).alias("detections"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
