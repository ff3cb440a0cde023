"""License scans: ordered signature rules, gated by keywords, with containment suppression.

RULES is a list of regexes over the text with A-Z lower-cased, each with its label and a keyword that
every match contains: names, sentences of the licenses' own texts and notices, and addresses.  A text
without any gate word runs none; another runs the rules whose keyword it contains, looked for with
white space and comment marks folded to one space, since sentences may be broken by them.  SPDX
expressions are read whole, beside the rules.  Detections are ordered by place; one that lies inside
another is suppressed, and of two on one interval the rule with the better priority stays.
DataFrame functions only.

The first tests of a text are plain searches for a few words, so most texts meet no regex but the one
that counts words.
"""

from __future__ import annotations

import functools
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table
from .spans import matches

#: What lies between words, whatever the case of A-Z. Splitting at it is far cheaper than extracting the words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: What stands before a name that is stated to be the license.
STATED = r"(?:Ld under |Ls?(?: type| name)?Q ?[:=] ?Q|Ls? is )"
#: label, keyword, pattern. A space stands for white space and comment marks, L for both spellings of license.
RULES = [
    # names
    ("gpl", "gnu general", r"gnu general public L"),
    ("gpl", "gpl", r"(?:gnu )?gpl(?: ?v?[123](?:\.0)?)?"),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public L"),
    ("lgpl", "library general", r"(?:gnu )?library general public L"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: ?v?[23](?:\.[01])?)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public L"),
    ("agpl", "agpl", r"(?:gnu )?agpl(?: ?v?[13](?:\.0)?)?"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation L"),
    ("apache", "apache", r"apache (?:software )?L"),
    ("mit", "mit", r"mit(?:/x11| x11)? L"),
    ("mit", "expat", r"expat L"),
    ("x11", "x11", r"x11 L"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2-clause|2-clause bsd|two-clause bsd|simplified bsd|freebsd) L"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3-clause|3-clause bsd|three-clause bsd|modified bsd|new bsd|revised bsd) L"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4-clause|4-clause bsd|four-clause bsd|original bsd|old bsd) L"),
    ("0bsd", "bsd", r"(?:zero-clause |0-clause )bsd(?: L)?"),
    ("bsd", "bsd", r"bsd(?:-style)? L"),
    ("isc", "isc", r"isc L"),
    ("mpl", "mozilla", r"mozilla public L"),
    ("mpl", "mpl", r"mpl ?v?[12]\.[01]"),
    ("npl", "netscape", r"netscape public L"),
    ("epl", "eclipse", r"eclipse public L"),
    ("edl", "eclipse", r"eclipse distribution L"),
    ("cpl", "common public", r"common public L"),
    ("ipl", "ibm public", r"ibm public L"),
    ("cpal", "common public attribution", r"common public attribution L"),
    ("cddl", "common development", r"common development and distribution L"),
    ("eupl", "european union", r"european union public L"),
    ("eupl", "eupl", r"eupl(?: ?v?1\.[012])?"),
    ("cecill", "cecill", r"cecill(?:-[abc])?(?: ?v?[12](?:\.[01])?)?"),
    ("artistic", "artistic", r"(?:perl )?artistic L"),
    ("zlib", "zlib", r"zlib(?:/libpng)? L"),
    ("libpng", "libpng", r"libpng L"),
    ("boost", "boost", r"boost software L"),
    ("bsl", "business source", r"business source L"),
    ("sspl", "server side", r"server side public L"),
    ("elastic", "elastic", r"elastic L"),
    ("python", "python", r"(?:python software foundation|python) L(?: agreement)?"),
    ("python", "psf", r"psf L(?: agreement)?"),
    ("ruby", "ruby", r"ruby(?:'s)? L"),
    ("php", "php", r"php L"),
    ("openssl", "openssl", r"openssl L"),
    ("postgresql", "postgresql", r"postgresql L"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("cc0", "cc0", r"(?:creative commons )?cc0(?: 1\.0)?(?: universal)?"),
    ("cc-by-nc-nd", "noncommercial-noderiv", r"(?:creative commons )?attribution-noncommercial-noderiv(?:ative)?s"),
    ("cc-by-nc-sa", "noncommercial-sharealike", r"(?:creative commons )?attribution-noncommercial-sharealike"),
    ("cc-by-nc", "noncommercial", r"(?:creative commons )?attribution-noncommercial"),
    ("cc-by-nd", "noderiv", r"(?:creative commons )?attribution-noderiv(?:ative)?s"),
    ("cc-by-sa", "sharealike", r"(?:creative commons )?attribution-share ?alike"),
    ("cc-by-nc-nd", "cc", r"cc(?: |-)by-nc-nd(?: [1234]\.[05])?"),
    ("cc-by-nc-sa", "cc", r"cc(?: |-)by-nc-sa(?: [1234]\.[05])?"),
    ("cc-by-nc", "cc", r"cc(?: |-)by-nc(?: [1234]\.[05])?"),
    ("cc-by-nd", "cc", r"cc(?: |-)by-nd(?: [1234]\.[05])?"),
    ("cc-by-sa", "cc", r"cc(?: |-)by-sa(?: [1234]\.[05])?"),
    ("cc-by", "cc", r"cc(?: |-)by(?: [1234]\.[05])?"),
    ("cc-by", "creative commons", r"creative commons attribution(?: L)?"),
    ("creative-commons", "creative commons", r"creative commons (?:public )?L"),
    ("odbl", "open database", r"open (?:data commons open )?database L"),
    ("odc-by", "open data commons", r"open data commons attribution L"),
    ("pddl", "open data commons", r"open data commons public domain dedication (?:and|&) L"),
    ("cdla", "community data", r"community data L agreement"),
    ("ogl", "open government", r"open government L"),
    ("open-game", "open game", r"open game L"),
    ("ofl", "open font", r"(?:sil )?open font L"),
    ("public-domain", "public domain", r"public domain(?: dedication)?"),
    ("ms-pl", "microsoft public", r"microsoft public L"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal L"),
    ("afl", "academic free", r"academic free L"),
    ("osl", "open software", r"open software L"),
    ("ecl", "educational community", r"educational community L"),
    ("upl", "universal permissive", r"universal permissive L"),
    ("blueoak", "blue oak", r"blue oak model L"),
    ("mulan", "mulan", r"mulan (?:permissive software|psl|publ?) ?(?:L)?(?:,? ?v?[12])?"),
    ("lppl", "latex project", r"latex project public L"),
    ("vim", "vim", r"vim L"),
    ("zpl", "zope", r"zope public L"),
    ("tcl", "tcl", r"tcl(?:/tk)? L"),
    ("w3c", "w3c", r"w3c (?:software (?:notice and )?)?L"),
    ("unicode", "unicode", r"unicode(?: data files and software)? L(?: agreement)?"),
    ("icu", "icu", r"icu L"),
    ("curl", "curl", r"curl L"),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa (?:open source )?L"),
    ("ncsa", "university of illinois", r"university of illinois(?:/ncsa)? open source L"),
    ("sleepycat", "sleepycat", r"sleepycat (?:public )?L"),
    ("qpl", "q public", r"q public L"),
    ("apsl", "apple public source", r"apple public source L"),
    ("spl", "sun public", r"sun public L"),
    ("sissl", "sun industry", r"sun industry standards source L"),
    ("intel", "intel", r"intel (?:simplified software|open source) L"),
    ("rpsl", "realnetworks", r"realnetworks public source L"),
    ("rpl", "reciprocal public", r"reciprocal public L"),
    ("watcom", "watcom", r"(?:sybase open )?watcom public L"),
    ("fair", "fair", r"fair L"),
    ("ntp", "ntp", r"ntp L"),
    ("beerware", "beer", r"beer-?ware(?: L)?"),
    ("json", "json", r"json L"),
    ("hippocratic", "hippocratic", r"hippocratic L"),
    ("parity", "parity", r"parity public L"),
    ("polyform", "polyform", r"polyform (?:noncommercial|small business|strict|shield|perimeter|internal use|free trial)(?: L)?"),
    ("commons-clause", "commons clause", r"commons clause(?: L condition)?"),
    ("functional-source", "functional source", r"functional source L"),
    ("cal", "cryptographic autonomy", r"cryptographic autonomy L"),
    ("openrail", "openrail", r"(?:creativeml |bigscience |bigcode )?openrail(?:\+\+)?(?:-m)?(?: L)?"),
    ("openrail", "bloom rail", r"bigscience bloom rail(?: 1\.0)? L"),
    ("llama", "llama", r"(?:meta )?llama [234](?:\.[0-9])? community L(?: agreement)?"),
    ("gemma", "gemma", r"gemma terms of use"),
    ("proprietary", "user licen", r"end[ -]user L agreement"),
    # sentences of permissive texts
    ("mit", "person obtaining", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "substantial portions", r"the above copyright notice and this permission notice(?: \(including the next paragraph\))? shall be included in all copies or substantial portions of the software"),
    ("mit", "warranty of any kind", r"the software is provided Qas isQ,? without warranty of any kind, express or implied"),
    ("mit-0", "person obtaining", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \(the QsoftwareQ\), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so\. the software"),
    ("bsd", "source and binary forms", r"redistribution and use(?: of this software)? in source and binary forms,? with or without modification,? (?:are|is) permitted"),
    ("bsd", "redistributions of source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse or promote", r"neither the names? of .{1,120}? nor the names of (?:its|their|any|the) contributors may be used to endorse or promote"),
    ("bsd-3-clause", "endorse or promote", r"the names? of the (?:author|copyright holder)s? may not be used to endorse or promote products"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", "express or implied warranties", r"this software is provided by .{1,80}? Qas isQ and any express or implied warranties"),
    ("bsd-3-clause-clear", "patent rights", r"no express or implied L(?:s)? to any party's patent rights are granted by this L"),
    ("isc", "with or without fee", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice"),
    ("0bsd", "with or without fee", r"permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted\."),
    ("isc", "regard to this software", r"the author disclaims all warranties with regard to this software"),
    ("hpnd", "hereby granted", r"permission to use, copy, modify,? (?:and|distribute, and) (?:distribute|sell) this software and its documentation for any purpose(?: is hereby granted without fee| and without fee is hereby granted)"),
    ("postgresql", "written agreement", r"for any purpose, without fee, and without a written agreement is hereby granted"),
    ("ntp", "hereby granted", r"permission to use, copy, modify, and distribute this software and its documentation for any purpose with or without fee is hereby granted"),
    ("zlib", "held liable", r"this software is provided 'as-is', without any express or implied warranty\. in no event will the authors? be held liable"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", "altered source", r"altered source versions must be plainly marked as such"),
    ("boost", "organization obtaining", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software"),
    ("json", "not evil", r"the software shall be used for good, not evil"),
    ("curl", "daniel stenberg", r"copyright \(c\) [0-9]{4}(?: ?- ?[0-9]{4})?,? daniel stenberg"),
    ("openssl", "openssl project", r"this product includes software developed by the openssl project"),
    ("unicode", "data files", r"permission is hereby granted, free of charge, to any person obtaining a copy of (?:the unicode )?data files"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "do what the fuck", r"do what the fuck you want to(?: public L)?"),
    ("upl", "lrgrwrks", r"to deal in both \(a\) the software, and \(b\) any piece of software and/or hardware listed in the lrgrwrks\.txt"),
    ("blueoak", "permission to work", r"this L gives everyone as much permission to work with this software as possible"),
    ("artistic", "artistic control", r"maintain(?:s)? some semblance of artistic control"),
    ("afl", "academic free", r"licensed under the academic free L version [123]\.[012]"),
    # the same of licenses with conditions on patents, files or networks
    ("apache", "except in compliance", r"you may not use (?:this|these) (?:file|work|software)s? except in compliance with the L"),
    ("apache", "applicable law or agreed", r"unless required by applicable law or agreed to in writing, software distributed under the L is distributed on an Qas isQ basis"),
    ("apache", "apache software foundation", r"licensed to the apache software foundation \(asf\) under one or more contributor L agreements"),
    ("apache", "contributor hereby", r"each contributor hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (?:copyright|\(except as stated in this section\) patent) L"),
    ("mpl", "source code form", r"this source code form is subject to the terms of the mozilla public L"),
    ("mpl", "mpl was not", r"if a copy of the mpl was not distributed with this file"),
    ("mpl", "mozilla", r"the contents of this file are subject to the mozilla public L"),
    ("mpl", "incompatible with secondary", r"this source code form is Qincompatible with secondary LsQ"),
    ("npl", "netscape", r"the contents of this file are subject to the netscape public L"),
    ("epl", "accompanying materials", r"this program and the accompanying materials are made available under the terms of the eclipse public L"),
    ("epl", "secondary licenses", r"this source code may also be made available under the following secondary Ls"),
    ("cpl", "common public", r"the accompanying program is provided under the terms of this common public L"),
    ("cddl", "common development", r"the contents of this file are subject to the terms of the common development and distribution L"),
    ("cddl", "cddl header", r"cddl header (?:start|end)"),
    ("osl", "open software", r"licensed under the open software L version [123]\.[01]"),
    ("ms-pl", "accompanying software", r"this L governs use of the accompanying software\. if you use the software, you accept this L"),
    ("ecl", "educational community", r"licensed under the educational community L"),
    ("eupl", "eupl", r"licensed under the eupl"),
    ("lppl", "latex project", r"this work may be distributed and/or modified under the conditions of the latex project public L"),
    ("lppl", "lppl maintenance", r"this work has the lppl maintenance status"),
    ("cecill", "french law", r"governed by the cecill(?:-[abc])? L under french law"),
    ("mulan", "mulan", r"you can use this software according to the terms and conditions of the mulan psl"),
    # of copyleft
    ("gpl", "free software foundation", r"gnu general public L as published by the free software foundation"),
    ("gpl", "redistribute it", r"this program is free software[;:,]? (?:you|and you) can redistribute it and/or modify it"),
    ("gpl", "will be useful", r"this program is distributed in the hope that it will be useful, but without any warranty"),
    ("gpl", "you should have received", r"you should have received a copy of the gnu general public L along with (?:this program|.{1,60}?)[;,.] if not"),
    ("gpl", "at your option", r"either version [123](?:\.0)? of the L, or \(at your option\) any later version"),
    ("gpl", "verbatim copies", r"everyone is permitted to copy and distribute verbatim copies of this L document"),
    ("gpl", "freedom to share", r"the Ls for most software (?:and other practical works )?are designed to take away your freedom to share and change"),
    ("gpl", "copyleft", r"the gnu general public L is a free, copyleft L for software"),
    ("lgpl", "this library is free", r"this library is free software[;:,]? you can redistribute it and/or modify it"),
    ("lgpl", "this library is distributed", r"this library is distributed in the hope that it will be useful, but without any warranty"),
    ("agpl", "remote network", r"remote network interaction; use with the gnu general public L"),
    ("agpl", "interacting with it remotely", r"all users interacting with it remotely through a computer network"),
    ("gfdl", "invariant sections", r"with no invariant sections, (?:with )?no front-cover texts,? and (?:with )?no back-cover texts"),
    ("gfdl", "documentation license", r"permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation L"),
    # of content, data and fonts
    ("creative-commons", "creative commons", r"this work is licensed under (?:the|a) creative commons"),
    ("cc0", "to the extent possible", r"to the extent possible under law, .{1,100}? (?:has|have) waived all copyright and related or neighbou?ring rights"),
    ("cc0", "automatically confer", r"the laws of most jurisdictions throughout the world automatically confer exclusive copyright and related rights"),
    ("cc-by", "appropriate credit", r"you must give appropriate credit, provide a link to the L, and indicate if changes were made"),
    ("cc-by-sa", "contributions under the same", r"you must distribute your contributions under the same L as the original"),
    ("ofl", "font software", r"this font software is licensed under the sil open font L"),
    ("ofl", "reserved font name", r"with reserved font names?"),
    ("odbl", "open database", r"this .{1,80}? is made available under the open database L"),
    ("ogl", "public sector information", r"contains public sector information licensed under the open government L"),
    ("open-game", "open game", r"open game L v(?:ersion)? ?1\.0a? copyright 2000,? wizards of the coast"),
    ("public-domain", "public domain", r"(?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", r"i,? the copyright holder of this work,? (?:hereby )?release this work into the public domain"),
    # of terms with restrictions
    ("bsl", "change date", r"change date:? .{1,40}? change L"),
    ("commons-clause", "right to sell", r"the L does not grant to you,? (?:and you do not have )?the right to sell the software"),
    ("polyform", "required notice", r"required notice: copyright .{1,100}? polyform"),
    ("llama", "intellectual property", r"a non-exclusive, worldwide, non-transferable and royalty-free limited L under meta's intellectual property"),
    ("proprietary", "all rights reserved", r"copyright (?:\(c\)|©)? ?[0-9]{4}(?: ?[-–,] ?[0-9]{4})* .{1,80}?\.? all rights reserved"),
    ("proprietary", "confidential", r"(?:this (?:file|software|document) (?:is|contains) )?(?:strictly )?(?:confidential and proprietary|proprietary and confidential)(?: information)?"),
    ("proprietary", "is strictly prohibited", r"unauthori[sz]ed copying of this (?:file|software|document),? via any medium,? is strictly prohibited"),
    ("proprietary", "no part of this", r"no part of this (?:publication|book|work|document) may be reproduced"),
    # addresses
    ("gpl", "gnu.org", r"gnu\.org/(?:L|copyleft)s?/(?:old-Ls/)?gpl(?:-[123]\.0)?(?:\.(?:html|txt|en\.html))?"),
    ("lgpl", "gnu.org", r"gnu\.org/(?:L|copyleft)s?/(?:old-Ls/)?lgpl(?:-[23]\.[01])?(?:\.(?:html|txt))?"),
    ("agpl", "gnu.org", r"gnu\.org/Ls/agpl(?:-3\.0)?(?:\.(?:html|txt))?"),
    ("gfdl", "gnu.org", r"gnu\.org/(?:L|copyleft)s?/fdl(?:-1\.[123])?(?:\.(?:html|txt))?"),
    ("gpl", "gnu.org", r"gnu\.org/Ls/?"),
    ("apache", "apache.org", r"apache\.org/Ls(?:/L-[12]\.[01](?:\.(?:html|txt))?)?"),
    ("mpl", "mozilla.org", r"mozilla\.org/(?:en-us/)?mpl(?:/[12]\.[01])?"),
    ("epl", "eclipse.org", r"eclipse\.org/(?:legal|org/documents)/epl-(?:v10|v20|2\.0)(?:\.html)?"),
    ("edl", "eclipse.org", r"eclipse\.org/org/documents/edl-v10(?:\.php)?"),
    ("boost", "boost.org", r"boost\.org/L_1_0\.txt"),
    ("unlicense", "unlicense.org", r"unlicense\.org"),
    ("wtfpl", "wtfpl.net", r"wtfpl\.net"),
    ("ofl", "sil.org", r"scripts\.sil\.org/ofl"),
    ("artistic", "perlfoundation.org", r"perlfoundation\.org/artistic[_-]L"),
    ("eupl", "ec.europa.eu", r"ec\.europa\.eu/(?:idabc/)?eupl"),
    ("cecill", "cecill.info", r"cecill\.info"),
    ("ms-pl", "opensource.org", r"opensource\.org/Ls/ms-pl"),
    ("ms-rl", "opensource.org", r"opensource\.org/Ls/ms-rl"),
    ("mit", "opensource.org", r"opensource\.org/Ls/mit(?:-L\.php)?"),
    ("bsd-3-clause", "opensource.org", r"opensource\.org/Ls/bsd-3-clause"),
    ("bsd-2-clause", "opensource.org", r"opensource\.org/Ls/bsd-2-clause"),
    ("bsd", "opensource.org", r"opensource\.org/Ls/bsd-L(?:\.php)?"),
    ("isc", "opensource.org", r"opensource\.org/Ls/isc"),
    ("afl", "opensource.org", r"opensource\.org/Ls/afl-3\.0"),
    ("osl", "opensource.org", r"opensource\.org/Ls/osl-3\.0"),
    ("cc0", "creativecommons.org", r"creativecommons\.org/publicdomain/zero(?:/1\.0)?"),
    ("public-domain", "creativecommons.org", r"creativecommons\.org/publicdomain/mark(?:/1\.0)?"),
    ("cc-by-nc-nd", "creativecommons.org", r"creativecommons\.org/Ls/by-nc-nd(?:/[1234]\.[05])?"),
    ("cc-by-nc-sa", "creativecommons.org", r"creativecommons\.org/Ls/by-nc-sa(?:/[1234]\.[05])?"),
    ("cc-by-nc", "creativecommons.org", r"creativecommons\.org/Ls/by-nc(?:/[1234]\.[05])?"),
    ("cc-by-nd", "creativecommons.org", r"creativecommons\.org/Ls/by-nd(?:/[1234]\.[05])?"),
    ("cc-by-sa", "creativecommons.org", r"creativecommons\.org/Ls/by-sa(?:/[1234]\.[05])?"),
    ("cc-by", "creativecommons.org", r"creativecommons\.org/Ls/by(?:/[1234]\.[05])?"),
    ("odbl", "opendatacommons.org", r"opendatacommons\.org/Ls/odbl"),
    ("odc-by", "opendatacommons.org", r"opendatacommons\.org/Ls/by"),
    ("pddl", "opendatacommons.org", r"opendatacommons\.org/Ls/pddl"),
    ("cdla", "cdla", r"cdla\.(?:io|dev)/(?:permissive|sharing)-[12][.-]0"),
    ("ogl", "nationalarchives", r"nationalarchives\.gov\.uk/doc/open-government-L"),
    ("polyform", "polyformproject", r"polyformproject\.org/Ls"),
    ("elastic", "elastic.co", r"elastic\.co/Ls?/elastic-L"),
    ("bsl", "mariadb.com", r"mariadb\.com/bsl11"),
    ("commons-clause", "commonsclause", r"commonsclause\.com"),
    # statements without the word license behind the name
    ("mit", "mit", STATED + r"(?:the )?mit(?:/x11|/expat)?"),
    ("mit", "mit", r"L mit(?=[ \t]*(?:[.,;\n)]|$))"),
    ("mit", "mit", r"mit[- ]Ld"),
    ("apache", "apache", STATED + r"(?:the )?apache(?:[- ]v?(?:ersion )?[12](?:\.[01])?)?"),
    ("apache", "apache", r"apache[- ]Ld"),
    ("apache", "asl", STATED + r"(?:the )?asl ?2(?:\.0)?"),
    ("bsd-2-clause", "bsd", STATED + r"(?:the )?(?:simplified bsd|freebsd)"),
    ("bsd-3-clause", "bsd", STATED + r"(?:the )?(?:new bsd|modified bsd|revised bsd)"),
    ("bsd", "bsd", STATED + r"(?:the )?bsd(?:-style)?(?![- ][234])"),
    ("bsd", "bsd", r"bsd[- ]Ld"),
    ("isc", "isc", STATED + r"(?:the )?isc"),
    ("mpl", "mpl", STATED + r"(?:the )?mpl(?: ?v?[12](?:\.[01])?)?"),
    ("mpl", "mozilla", STATED + r"(?:the )?mozilla public"),
    ("epl", "epl", STATED + r"(?:the )?epl(?: ?v?[12](?:\.0)?)?"),
    ("zlib", "zlib", STATED + r"(?:the )?zlib(?:/libpng)?"),
    ("boost", "boost", STATED + r"(?:the )?boost(?: 1\.0)?"),
    ("boost", "bsl-1.0", STATED + r"bsl-1\.0"),
    ("unlicense", "unlicense", STATED + r"(?:the )?unlicense"),
    ("postgresql", "postgresql", STATED + r"(?:the )?postgresql"),
    ("python", "psf", STATED + r"(?:the )?psf(?: ?v?2)?"),
    ("ofl", "ofl", STATED + r"(?:the )?(?:sil )?ofl(?: ?v?1\.1)?"),
    ("public-domain", "public domain", STATED + r"public domain"),
    ("proprietary", "proprietary", STATED + r"proprietary"),
    # identifiers that stand alone
    ("apache", "apache", r"apache[- ]?(?:v|version )?2\.0(?!\.?[0-9])"),
    ("bsd-2-clause", "bsd", r"bsd[- ]2[- ]clause|(?:2|two)-clause bsd"),
    ("bsd-3-clause", "bsd", r"bsd[- ]3[- ]clause|(?:3|three)-clause bsd"),
    ("bsd-4-clause", "bsd", r"bsd[- ]4[- ]clause|(?:4|four)-clause bsd"),
    ("mpl", "mpl-", r"mpl-[12]\.[01](?!\.?[0-9])"),
    ("epl", "epl-", r"epl-[12]\.0(?!\.?[0-9])"),
    ("cc0", "cc0-1.0", r"cc0-1\.0"),
]
#: label, SPDX identifiers (pattern)
SPDX = [
    ("gpl", r"gpl-[123](?:\.0)?(?:-only|-or-later|\+)?|gpl-[123]\.0-with-[a-z-]+"), ("lgpl", r"lgpl-[23]\.[01](?:-only|-or-later|\+)?"), ("agpl", r"agpl-[13]\.0(?:-only|-or-later|\+)?"),
    ("gfdl", r"gfdl-1\.[123](?:-only|-or-later)?"), ("apache", r"apache-[12]\.[01]"), ("mit", r"mit"), ("mit-0", r"mit-0"), ("x11", r"x11"), ("bsd-2-clause", r"bsd-2-clause(?:-patent)?"),
    ("bsd-3-clause", r"bsd-3-clause"), ("bsd-3-clause-clear", r"bsd-3-clause-clear"), ("bsd-4-clause", r"bsd-4-clause"), ("0bsd", r"0bsd"), ("isc", r"isc"), ("mpl", r"mpl-[12]\.[01]"), ("npl", r"npl-1\.[01]"),
    ("epl", r"epl-[12]\.0"), ("cpl", r"cpl-1\.0"), ("ipl", r"ipl-1\.0"), ("cpal", r"cpal-1\.0"), ("cddl", r"cddl-1\.[01]"), ("eupl", r"eupl-1\.[012]"), ("cecill", r"cecill-(?:[abc]|[12]\.[01]|b|c)"),
    ("artistic", r"artistic-[12]\.0"), ("zlib", r"zlib"), ("libpng", r"libpng(?:-2\.0)?"), ("boost", r"bsl-1\.0"), ("bsl", r"busl-1\.1"), ("sspl", r"sspl-1\.0"), ("elastic", r"elastic-2\.0"),
    ("python", r"python-2\.0|psf-2\.0"), ("ruby", r"ruby"), ("php", r"php-3\.0[01]?"), ("openssl", r"openssl"), ("postgresql", r"postgresql"), ("unlicense", r"unlicense"), ("wtfpl", r"wtfpl"), ("cc0", r"cc0-1\.0"),
    ("cc-by-nc-nd", r"cc-by-nc-nd-[1234]\.[05](?:-[a-z]+)?"), ("cc-by-nc-sa", r"cc-by-nc-sa-[1234]\.[05](?:-[a-z]+)?"), ("cc-by-nc", r"cc-by-nc-[1234]\.[05](?:-[a-z]+)?"), ("cc-by-nd", r"cc-by-nd-[1234]\.[05](?:-[a-z]+)?"),
    ("cc-by-sa", r"cc-by-sa-[1234]\.[05](?:-[a-z]+)?"), ("cc-by", r"cc-by-[1234]\.[05](?:-[a-z]+)?"), ("odbl", r"odbl-1\.0"), ("odc-by", r"odc-by-1\.0"), ("pddl", r"pddl-1\.0"), ("ogl", r"ogl-uk-[123]\.0"), ("ofl", r"ofl-1\.[01]"),
    ("ms-pl", r"ms-pl"), ("ms-rl", r"ms-rl"), ("afl", r"afl-[123]\.[012]"), ("osl", r"osl-[123]\.[01]"), ("ecl", r"ecl-[12]\.0"), ("upl", r"upl-1\.0"), ("blueoak", r"blueoak-1\.0\.0"), ("mulan", r"mulanpsl-[12]\.0"),
    ("lppl", r"lppl-1\.[0-3][ac]?"), ("vim", r"vim"), ("zpl", r"zpl-[12]\.[01]"), ("tcl", r"tcl"), ("w3c", r"w3c"), ("unicode", r"unicode-(?:dfs-201[56]|3\.0)"), ("icu", r"icu"), ("curl", r"curl"), ("ncsa", r"ncsa"),
    ("sleepycat", r"sleepycat"), ("qpl", r"qpl-1\.0"), ("apsl", r"apsl-[12]\.[012]"), ("hpnd", r"hpnd"), ("ntp", r"ntp"), ("beerware", r"beerware"), ("json", r"json"), ("fair", r"fair"), ("hippocratic", r"hippocratic-2\.1"),
    ("parity", r"parity-7\.0\.0"), ("polyform", r"polyform-[a-z-]+-1\.0\.0"),
]
#: What may stand before a name: a notice. A match that begins so, or ends in a version, counts for more.
LEAD = r"(?:(?:licensed|released|distributed|published|available|offered|dual-licensed|made available|subject to|covered by|governed by|permitted) (?:under |by )?(?:the terms (?:of|and conditions of) )?(?:the |an? )?|under the terms of (?:the |an? )?)?"
VERSION = r"(?:,? \(?v(?:ersion|\.)? ?[0-9][0-9.]*\)?(?: or (?:any )?later(?: version)?)?| [0-9]\.[0-9])?"
NAMED = next(i for i, rule in enumerate(RULES) if rule[1] == "person obtaining")
#: A text without any of these has no rule's match: every keyword, or the pattern's L, holds one of them. Single words, since
#: sentences may be broken; words that ordinary pages seldom hold.
GATE = (
    "licen", "gpl", "spdx", "cc0", "hereby", "warrant", "redistribut", "copyright", "acknowledg", "attribution", "endorse", "misrepresented", "altered", "evil", "beerware", "beer-ware", "openssl", "lrgrwrks", "unencumbered", "fuck", "wtf", "artistic",
    "cddl", "lppl", "eupl", "cecill", "mulan", "invariant", "remotely", "reserved", "reproduced", "confidential", "unauthori", "gemma", "openrail", "polyform", "commons", "mozilla.org", "eclipse.org", "sil.org", "copyleft", "cdla", "mariadb.com", "bsd",
    "sublicense", "apache", "epl-",
)
#: The same, but as words: the letters are part of common words.
WHOLE = {"cc": r"(?<![a-z0-9])cc[^a-z0-9]", "mpl": r"(?<![a-z0-9])mpl(?![a-z])", "domain": r"public[\s*#/]*domain"}
MARKS = r"[\s*#/]+"
SPDX_ID = r"[a-z0-9][a-z0-9.+-]*"
TAG = "spdx-license-identifier:"
EXPRESSION = rf"{TAG}[\s*#/(]*({SPDX_ID}(?:[ \t)]+(?:and|or|with)[ \t(]+{SPDX_ID})*)"
DETECTION = "struct<start:int,end:int,priority:int,rule:int,label:string,weight:double>"


def spaced(pattern: str) -> str:
    """The pattern with its letters L and Q filled in and its spaces (outside of sets) standing for white space and comment marks."""
    pattern = pattern.replace("L", "licen[sc]e").replace("Q", "[\"'“”‘’]?").replace(" ?", r"[\s*#/]*")
    return re.sub(r" (?![^\[\]]*\])", lambda _: r"[\s*#/]+", pattern)


def rules() -> list[tuple[int, str, str, str]]:
    """rule number (its priority), label, keyword, pattern."""
    found = []
    for n, (label, keyword, pattern) in enumerate(RULES):
        pattern = f"{LEAD}(?:{pattern}){VERSION}" if n < NAMED else f"(?:{pattern})"
        found.append((n, label, keyword, rf"(?<![a-z0-9]){spaced(pattern)}(?![a-z0-9])"))
    return found


def rule_array() -> Column:
    """The rules as one constant."""
    rows = [{"rule": n, "label": label, "keyword": k, "pattern": x} for n, label, k, x in rules()]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<rule:int,label:string,keyword:string,pattern:string>>")


def weight(rule: Column, found: Column) -> Column:
    """A sentence or an address: 0.9. A name: 0.95 in a notice, 0.8 with a version, else 0.6."""
    named = F.when(F.rlike(found, F.lit(spaced(f"^{LEAD[:-1]}"))), 0.95).when(F.rlike(found, F.lit(r"[0-9]\)?$|later(?:[\s*#/]+version)?$")), 0.8).otherwise(0.6)
    return F.when(rule >= NAMED, 0.9).otherwise(named)


def detections(text: Column, folded: Column) -> Column:
    """array of DETECTION after suppression; text is lower-cased, folded is the same with MARKS as one space."""
    run = F.filter(rule_array(), lambda r: F.contains(folded, r["keyword"]))
    every = F.flatten(F.transform(run, lambda r: F.transform(matches(text, r["pattern"]), lambda m: F.struct(
        m["start"].alias("start"), (-m["end"]).alias("minus_end"), r["rule"].alias("rule"), r["label"].alias("label"), weight(r["rule"], m["found"]).alias("weight")
    ))))
    start = F.struct(F.lit(-1).alias("reached"), F.array().cast("array<struct<start:int,minus_end:int,rule:int,label:string,weight:double>>").alias("kept"))
    # in order of start, longest first: what ends no later than an earlier one lies inside it
    kept = F.aggregate(F.array_sort(every), start, lambda a, d: F.when(
        -d["minus_end"] <= a["reached"], a
    ).otherwise(F.struct((-d["minus_end"]).alias("reached"), F.concat(a["kept"], F.array(d)).alias("kept"))))["kept"]
    return F.transform(kept, lambda d: F.struct(d["start"].alias("start"), (-d["minus_end"]).alias("end"), d["rule"].alias("priority"), d["rule"].alias("rule"), d["label"].alias("label"), d["weight"].alias("weight")))


def expression_labels(text: Column) -> Column:
    """Labels of all identifiers in the text's SPDX expressions; text is lower-cased."""
    ids = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(EXPRESSION), F.lit(1)), lambda e: F.regexp_extract_all(e, F.lit(SPDX_ID), F.lit(0))))
    known = F.from_json(F.lit(json.dumps([{"label": label, "pattern": f"^(?:{x})$"} for label, x in SPDX])), "array<struct<label:string,pattern:string>>")
    found = F.filter(known, lambda k: F.exists(ids, lambda i: F.rlike(i, k["pattern"])))
    return F.array_distinct(F.transform(found, lambda k: k["label"]))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BETWEEN), "")


def phrase_places(words: Column) -> Column:
    """Word numbers at which a phrase of PHRASES starts; no two phrases start alike."""

    def starts(i: Column) -> Column:
        found = F.lit(False)
        for phrase in PHRASES:
            here = F.lit(True)
            for k, w in enumerate(phrase.split()):
                here = here & (F.get(words, i + k) == w)
            found = found | here
        return F.coalesce(found, F.lit(False))

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), starts)


def any_of(text: Column, stems: tuple[str, ...]) -> Column:
    found = F.contains(text, F.lit(stems[0]))
    for stem in stems[1:]:
        found = found | F.contains(text, F.lit(stem))
    return found


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, places (word numbers of the phrases), base_labels (array), found (detections),
    labels (array), score for every row.

    Null and empty texts have no words and no labels, score 0.  Repeated rows are scanned alike.
    labels are the distinct labels of phrases, detections and SPDX expressions, sorted; score is the
    largest weight of a detection, 1 for a known identifier in an SPDX expression, at least 0.6 where
    a phrase stands.  Extra columns are not returned.
    """
    # one lower-cased copy decides which texts are looked at; those alone are folded and split
    seen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("low", F.lower("text"))
    whole = [F.contains("low", F.lit(w)) & F.rlike("low", F.lit(x)) for w, x in WHOLE.items()]
    marked = seen.select("doc_id", "text", F.size(words_of(F.col("text"))).cast("long").alias("n_words"), functools.reduce(lambda a, b: a | b, whole, any_of(F.col("low"), GATE)).alias("open"))
    lower = ascii_lower(F.col("text"))
    # one element: what a lambda is given is computed once, not once for each rule
    forms = F.array(F.struct(lower.alias("lower"), F.regexp_replace(lower, MARKS, " ").alias("folded")))
    when_open = lambda column, kind: F.when(F.col("open"), column).otherwise(F.array().cast(kind))
    found = marked.select(
        "doc_id", "n_words",
        when_open(with_words(lower), "array<struct<at:int,word:string>>").alias("phrases"),
        when_open(F.flatten(F.transform(forms, lambda x: detections(x["lower"], x["folded"]))), f"array<{DETECTION}>").alias("found"),
        F.when(F.col("open") & F.contains(lower, F.lit(TAG)), expression_labels(lower)).otherwise(F.array().cast("array<string>")).alias("expressed"),
    )
    first = F.create_map(*[F.lit(x) for p, lab in PHRASES.items() for x in (p.split()[0], lab)])
    base = F.array_sort(F.array_distinct(F.transform("phrases", lambda p: F.element_at(first, p["word"]))))
    labelled = found.select("doc_id", "n_words", F.col("phrases.at").alias("places"), "found", "expressed", base.alias("base_labels"))
    return labelled.select(
        "doc_id", "n_words", "places", "found", "base_labels",
        F.array_sort(F.array_union(F.array_union("base_labels", F.col("found.label")), "expressed")).alias("labels"),
        F.greatest(F.when(F.size("expressed") > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max(F.col("found.weight")), F.lit(0.0)), F.when(F.size("places") > 0, 0.6).otherwise(0.0)).alias("score"),
    )


def with_words(text: Column) -> Column:
    """The places of the phrases and their first words; text is lower-cased."""
    words = words_of(text)
    none = F.array().cast("array<struct<at:int,word:string>>")
    return F.aggregate(F.array(words), none, lambda _, w: F.when(F.size(w) > 0, F.transform(phrase_places(w), lambda i: F.struct(i.alias("at"), F.get(w, i).alias("word")))).otherwise(none))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
