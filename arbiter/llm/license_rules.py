"""Hand-written license signatures: (label, key words, expression).

A space in an expression stands for any white space (lines may break there),
a space with a question mark for any or none.
Every key word is a literal part of every match.  Texts are lower-cased.
Notices and body sentences tell licenses apart that share their names; short
forms are what people write in a line of documentation.
"""

# Notices that state a version and what may follow it.
NOTICES = [
    ("gpl-1.0-or-later", "gnu foundation later", r"gnu general public licen[cs]e as published by the free software foundation[;,] either version 1,? or \(at your option\) any later version"),
    ("gpl-2.0-or-later", "gnu foundation later", r"gnu general public licen[cs]e(?: \(gpl\))? as published by the free software foundation[;,.:]? either version 2(?:\.0)? of the licen[cs]e,? or,? \(at your option\),? any later version"),
    ("gpl-3.0-or-later", "gnu foundation later", r"gnu general public licen[cs]e(?: \(gpl\))? as published by the free software foundation[;,.:]? either version 3(?:\.0)? of the licen[cs]e,? or,? \(at your option\),? any later version"),
    ("gpl-2.0-only", "gnu foundation version", r"gnu general public licen[cs]e,? version 2,? as published by the free software foundation"),
    ("gpl-3.0-only", "gnu foundation version", r"gnu general public licen[cs]e,? version 3,? as published by the free software foundation"),
    ("gpl-2.0", "gnu foundation version", r"gnu general public licen[cs]e as published by the free software foundation[;,.:]? version 2 of the licen[cs]e"),
    ("gpl-3.0", "gnu foundation version", r"gnu general public licen[cs]e as published by the free software foundation[;,.:]? version 3 of the licen[cs]e"),
    ("gpl-2.0", "terms version gnu", r"terms (?:and conditions )?of version 2 of the gnu general public licen[cs]e"),
    ("gpl-3.0", "terms version gnu", r"terms (?:and conditions )?of version 3 of the gnu general public licen[cs]e"),
    ("lgpl-2.0-or-later", "gnu library foundation later", r"gnu library general public licen[cs]e as published by the free software foundation[;,] either version 2 of the licen[cs]e,? or \(at your option\) any later version"),
    ("lgpl-2.1-or-later", "gnu lesser foundation later", r"gnu lesser general public licen[cs]e as published by the free software foundation[;,] either version 2\.1 of the licen[cs]e,? or \(at your option\) any later version"),
    ("lgpl-3.0-or-later", "gnu lesser foundation later", r"gnu lesser general public licen[cs]e as published by the free software foundation[;,] either version 3 of the licen[cs]e,? or \(at your option\) any later version"),
    ("lgpl-2.1", "gnu lesser foundation version", r"gnu lesser general public licen[cs]e version 2\.1,? as published by the free software foundation"),
    ("agpl-3.0-or-later", "gnu affero foundation later", r"gnu affero general public licen[cs]e as published by the free software foundation[;,] either version 3 of the licen[cs]e,? or \(at your option\) any later version"),
    ("agpl-3.0", "gnu affero version", r"gnu affero general public licen[cs]e,? version 3,? as published by the free software foundation"),
    ("gfdl-1.3-or-later", "free documentation later", r"gnu free documentation licen[cs]e,? version 1\.3 or any later version published by the free software foundation"),
    ("gfdl-1.2-or-later", "free documentation later", r"gnu free documentation licen[cs]e,? version 1\.2 or any later version published by the free software foundation"),
    ("gfdl-1.1-or-later", "free documentation later", r"gnu free documentation licen[cs]e,? version 1\.1 or any later version published by the free software foundation"),
    ("apache-2.0", "apache org", r"apache\.org/licen[cs]es/licen[cs]e-2\.0"),
    ("apache-1.1", "includes apache", r"this product includes software developed by the apache software foundation"),
    ("apache-2.0", "unless applicable writing", r"unless required by applicable law or agreed to in writing,? software distributed under the licen[cs]e is distributed on an"),
    ("mpl-1.1", "contents mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1\.1"),
    ("mpl-2.0", "form mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e,? v\. ?2\.0"),
    ("mpl-2.0", "mpl distributed obtain", r"if a copy of the mpl was not distributed with this file,? you can obtain one at"),
    ("epl-2.0", "accompanying eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e(?: v| version )?2\.0"),
    ("epl-1.0", "accompanying eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1\.0"),
    ("edl-1.0", "eclipse distribution", r"eclipse distribution licen[cs]e(?: v| -? ?v| version )? ?1\.0"),
    ("cddl-1.0", "contents common development", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("cpl-1.0", "common public", r"common public licen[cs]e(?:,? version|,? v)? ?1\.0"),
    ("ipl-1.0", "ibm public", r"ibm public licen[cs]e(?:,? version|,? v)? ?1\.0"),
    ("eupl-1.2", "eupl version", r"eupl,? version 1\.2"),
    ("eupl-1.1", "eupl version", r"eupl,? version 1\.1"),
]

# Sentences of the licenses' own texts.
SENTENCES = [
    ("mit", "restriction software", r"to deal in the software without restriction,? including without limitation the rights"),
    ("mit", "substantial portions", r"the above copyright notice and this permission notice(?: \(including the next paragraph\))? shall be included in all copies or substantial portions of the software"),
    ("mit", "noninfringement merchantability", r"the software is provided [\x22'“”]{0,2}as is[\x22'“”]{0,2},? without warranty of any kind,? express or implied,? including but not limited to the warranties of merchantability,? fitness for a particular purpose and noninfringement"),
    ("isc", "purpose fee granted", r"permission to use,? copy,? modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("0bsd", "purpose fee granted", r"permission to use,? copy,? modify,? and/or distribute this software for any purpose with or without fee is hereby granted\. the software is provided"),
    ("bsd-2-clause", "views conclusions documentation", r"the views and conclusions contained in the software and documentation are those of the authors"),
    ("bsd-3-clause", "names contributors endorse", r"nor the names of (?:its|any|the|other)(?: other)? contributors may be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", "neither names", r"neither the name of [\w\s,.&-]{1,80} nor the names of"),
    ("bsd-3-clause", "name endorse promote", r"the name of the author may not be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising mentioning", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", "binary reproduce", r"redistributions? in binary form must reproduce the above copyright notice"),
    ("bsd", "redistribution binary permitted", r"redistribution and use in source and binary forms,? with or without modification,? are permitted"),
    ("bsl-1.0", "organization accompanying covered", r"to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[cs]e"),
    ("bsl-1.0", "machine object processor", r"solely in the form of machine-executable object code generated by a source language processor"),
    ("zlib", "origin misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", "altered plainly marked", r"altered source versions must be plainly marked as such"),
    ("zlib", "notice removed distribution", r"this notice may not be removed or altered from any source distribution"),
    ("unlicense", "anyone compile distribute", r"anyone is free to copy,? modify,? publish,? use,? compile,? sell,? or distribute this software"),
    ("unlicense", "unlicense org", r"unlicense\.org"),
    ("cc0-1.0", "associated deed dedicated", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0-1.0", "creativecommons zero", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("public-domain", "creativecommons mark", r"creativecommons\.org/publicdomain/mark/1\.0"),
    ("pddl-1.0", "public domain dedication", r"public domain dedication and licen[cs]e"),
    ("odc-by-1.0", "commons attribution", r"open data commons attribution licen[cs]e"),
    ("odbl-1.0", "opendatacommons odbl", r"opendatacommons\.org/licen[cs]es/odbl"),
    ("ofl-1.1", "font software", r"this font software is licen[cs]ed under the sil open font licen[cs]e,? version 1\.1"),
    ("ofl-1.1", "scripts ofl", r"scripts\.sil\.org/ofl"),
    ("artistic-1.0", "refers collection", r"refers to the collection of files distributed by the copyright holder"),
    ("artistic-2.0", "intent artistic control", r"the intent is that the copyright holder maintains some artistic control over the development of that package"),
    ("psf-2.0", "psf agreement python", r"psf licen[cs]e agreement for python"),
    ("postgresql", "documentation written agreement", r"and its documentation for any purpose,? without fee,? and without a written agreement is hereby granted"),
    ("hpnd", "supporting documentation", r"that both that copyright notice and this permission notice appear in supporting documentation"),
    ("ncsa", "illinois ncsa", r"university of illinois/ncsa open source licen[cs]e"),
    ("json", "good evil", r"the software shall be used for good,? not evil"),
    ("beerware", "retain notice whatever stuff", r"as long as you retain this notice you can do whatever you want with this stuff"),
    ("openssl", "includes openssl", r"this product includes software developed by the openssl project"),
    ("ssleay", "cryptographic eric young", r"this product includes cryptographic software written by eric young"),
    ("php-3.01", "includes php", r"this product includes php software"),
    ("vim", "vim unmodified", r"there are no restrictions on distributing unmodified copies of vim"),
    ("sleepycat", "redistributions accompanied obtain", r"redistributions in any form must be accompanied by information on how to obtain complete source code"),
    ("wtfpl", "just what", r"you just do what the f\w{1,5} you want to"),
    ("gpl", "gnu org gpl", r"gnu\.org/licen[cs]es/gpl"),
    ("lgpl", "gnu org lgpl", r"gnu\.org/licen[cs]es/lgpl"),
    ("agpl", "gnu org agpl", r"gnu\.org/licen[cs]es/agpl"),
    ("gfdl", "gnu org fdl", r"gnu\.org/licen[cs]es/fdl"),
    ("gpl-2.0", "gnu org gpl", r"gnu\.org/licen[cs]es/(?:old-licen[cs]es/)?gpl-2\.0"),
    ("gpl-3.0", "gnu org gpl", r"gnu\.org/licen[cs]es/gpl-3\.0"),
    ("lgpl-2.1", "gnu org lgpl", r"gnu\.org/licen[cs]es/(?:old-licen[cs]es/)?lgpl-2\.1"),
    ("lgpl-3.0", "gnu org lgpl", r"gnu\.org/licen[cs]es/lgpl-3\.0"),
    ("agpl-3.0", "gnu org agpl", r"gnu\.org/licen[cs]es/agpl-3\.0"),
    ("gpl", "copy gnu along", r"you should have received a copy of the gnu general public licen[cs]e along with"),
    ("lgpl", "copy gnu lesser along", r"you should have received a copy of the gnu lesser general public licen[cs]e along with"),
    ("agpl", "copy gnu affero along", r"you should have received a copy of the gnu affero general public licen[cs]e along with"),
    ("mit", "opensource org mit", r"opensource\.org/licen[cs]es/mit"),
    ("bsd-3-clause", "opensource org bsd", r"opensource\.org/licen[cs]es/bsd-3-clause"),
    ("bsd-2-clause", "opensource org bsd", r"opensource\.org/licen[cs]es/bsd-2-clause"),
    ("isc", "opensource org isc", r"opensource\.org/licen[cs]es/isc"),
    ("apache-2.0", "opensource org apache", r"opensource\.org/licen[cs]es/apache-2\.0"),
    ("mpl-2.0", "mozilla org mpl", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("bsl-1.0", "boost org", r"boost\.org/licen[cs]e_1_0\.txt"),
    ("epl-2.0", "eclipse org legal", r"eclipse\.org/legal/epl-2\.0"),
    ("epl-1.0", "eclipse org legal", r"eclipse\.org/legal/epl-v10"),
]

# Names of licenses without a family of versions.
NAMES = [
    ("0bsd", "zero clause", r"(?:bsd )?zero(?:\s+|-)clause bsd(?: licen[cs]e)?|bsd zero clause licen[cs]e"),
    ("bsd-1-clause", "clause bsd", r"(?:1|one)-clause bsd licen[cs]e"),
    ("bsd-2-clause", "freebsd", r"freebsd licen[cs]e"),
    ("bsd-3-clause", "bsd clause", r"bsd(?:\s+|-)(?:3|three)(?:\s+|-)clause"),
    ("bsd-2-clause", "bsd clause", r"bsd(?:\s+|-)(?:2|two)(?:\s+|-)clause"),
    ("bsd-4-clause", "bsd clause", r"bsd(?:\s+|-)(?:4|four)(?:\s+|-)clause"),
    ("bsd-3-clause", "bsd style", r"(?:3|three)(?:\s+|-)clause bsd-style"),
    ("bsd", "bsd style", r"bsd-style licen[cs]e"),
    ("x11", "x11", r"x11 licen[cs]e"),
    ("ncsa", "ncsa", r"ncsa open source licen[cs]e"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("ruby", "ruby", r"ruby licen[cs]e"),
    ("php-3.01", "php", r"php licen[cs]e,?(?: version| v)? ?3\.01"),
    ("php-3.0", "php", r"php licen[cs]e,?(?: version| v)? ?3\.0\b"),
    ("openssl", "openssl", r"openssl licen[cs]e"),
    ("json", "json", r"json licen[cs]e"),
    ("beerware", "beer", r"beer-?ware licen[cs]e"),
    ("vim", "vim", r"vim licen[cs]e"),
    ("sleepycat", "sleepycat", r"sleepycat licen[cs]e"),
    ("sspl-1.0", "server side public", r"server side public licen[cs]e(?:,? (?:version |v)?1(?:\.0)?)?"),
    ("busl-1.1", "business source", r"business source licen[cs]e(?:,? (?:version |v)?1\.1)?"),
    ("elastic-2.0", "elastic", r"elastic licen[cs]e(?:,? (?:version |v)?2(?:\.0)?)?"),
    ("commons-clause", "commons clause", r"commons clause"),
    ("polyform-noncommercial-1.0.0", "polyform", r"polyform non-?commercial licen[cs]e"),
    ("polyform-small-business-1.0.0", "polyform", r"polyform small business licen[cs]e"),
    ("rsal", "source available", r"redis source available licen[cs]e"),
    ("mulanpsl-2.0", "mulan", r"mulan (?:permissive software licen[cs]e|psl),? ?v(?:ersion )?2"),
    ("mulanpsl-1.0", "mulan", r"mulan (?:permissive software licen[cs]e|psl),? ?v(?:ersion )?1"),
    ("blueoak-1.0.0", "blue oak", r"blue oak model licen[cs]e"),
    ("upl-1.0", "universal permissive", r"universal permissive licen[cs]e"),
    ("ms-pl", "microsoft public", r"microsoft public licen[cs]e|microsoft public licen[cs]e \(ms-pl\)"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal licen[cs]e"),
    ("cecill-2.1", "cecill", r"cecill(?: free software licen[cs]e agreement)?,? (?:version |v)?2\.1"),
    ("cecill-b", "cecill", r"cecill-b"),
    ("cecill-c", "cecill", r"cecill-c"),
    ("apsl-2.0", "apple public", r"apple public source licen[cs]e(?:,? (?:version |v)?2(?:\.0)?)?"),
    ("nasa-1.3", "nasa", r"nasa open source agreement(?:,? version)? ?1\.3"),
    ("qpl-1.0", "public", r"\bq public licen[cs]e(?:,? version)? ?1\.0"),
    ("intel", "intel", r"intel open source licen[cs]e"),
    ("w3c", "w3c", r"w3c(?:\(r\)|®)? software (?:and document )?notice and licen[cs]e"),
    ("unicode-dfs-2016", "unicode", r"unicode,? inc\.? licen[cs]e agreement"),
    ("icu", "icu", r"icu licen[cs]e"),
    ("curl", "curl", r"curl licen[cs]e"),
    ("libpng", "png", r"(?:png reference library|libpng) licen[cs]e"),
    ("imagemagick", "imagemagick", r"imagemagick licen[cs]e"),
    ("ftl", "freetype", r"freetype (?:project )?licen[cs]e"),
    ("info-zip", "info", r"info-zip licen[cs]e"),
    ("hpnd", "historical permission", r"historical permission notice and disclaimer"),
    ("ogl-uk-3.0", "open government", r"open government licen[cs]e,? (?:version |v)?3(?:\.0)?"),
    ("ogl-uk-2.0", "open government", r"open government licen[cs]e,? (?:version |v)?2(?:\.0)?"),
    ("opl-1.0", "open publication", r"open publication licen[cs]e"),
    ("odc-by-1.0", "odc", r"odc-by(?: ?1\.0)?"),
    ("creativeml-openrail-m", "creativeml", r"creativeml open ?rail(?:\+\+)?-m"),
    ("bigscience-openrail", "bigscience", r"bigscience (?:open )?rail(?:-m)? licen[cs]e"),
    ("openrail", "openrail", r"openrail(?:\+\+)?(?:-m)? licen[cs]e"),
    ("llama2", "llama community", r"llama 2 community licen[cs]e"),
    ("llama3", "llama community", r"llama 3(?:\.\d)? community licen[cs]e"),
    ("gemma", "gemma", r"gemma terms of use"),
    ("watcom-1.0", "watcom", r"sybase open watcom public licen[cs]e"),
    ("sissl", "sun industry", r"sun industry standards source licen[cs]e"),
    ("spl-1.0", "sun public", r"sun public licen[cs]e"),
    ("npl-1.1", "netscape public", r"netscape public licen[cs]e"),
    ("rpl-1.5", "reciprocal public", r"reciprocal public licen[cs]e"),
    ("cpal-1.0", "common attribution", r"common public attribution licen[cs]e"),
    ("ecl-2.0", "educational community", r"educational community licen[cs]e"),
    ("efl-2.0", "eiffel forum", r"eiffel forum licen[cs]e"),
    ("fair", "fair", r"\bfair licen[cs]e"),
    ("lucent-1.02", "lucent public", r"lucent public licen[cs]e"),
    ("motosoto", "motosoto", r"motosoto open source licen[cs]e"),
    ("nokia", "nokia", r"nokia open source licen[cs]e"),
    ("oclc-2.0", "oclc", r"oclc research public licen[cs]e"),
    ("rpsl-1.0", "realnetworks", r"realnetworks public source licen[cs]e"),
    ("simpl-2.0", "simple public", r"simple public licen[cs]e"),
    ("vsl-1.0", "vovida", r"vovida software licen[cs]e"),
    ("xnet", "x.net", r"\bx\.net licen[cs]e"),
    ("zend-2.0", "zend", r"zend (?:engine )?licen[cs]e"),
    ("tcl", "tcl", r"tcl/tk licen[cs]e"),
    ("bittorrent-1.1", "bittorrent", r"bittorrent open source licen[cs]e"),
    ("naumen", "naumen", r"naumen public licen[cs]e"),
    ("condor-1.1", "condor", r"condor public licen[cs]e"),
    ("ijg", "independent jpeg", r"this software is based in part on the work of the independent jpeg group"),
    ("mit", "mit", r"mit-style licen[cs]e|mit/x11(?: licen[cs]e)?"),
    ("mit", "mit", r"mit(?:\s+|-)licen[cs]ed"),
    ("mit", "under mit", r"(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?mit\b"),
    ("isc", "under isc", r"(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?isc\b"),
    ("bsd", "under bsd", r"(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?bsd\b"),
    ("wtfpl", "wtfpl", r"\bwtfpl\b"),
    ("public-domain", "public domain", r"this (?:work|software|file|code) is in the public domain"),
    ("proprietary", "confidential trade secret", r"confidential (?:information )?and (?:a )?trade secrets?"),
    ("proprietary", "unauthorized prohibited", r"unauthorized (?:copying|use|reproduction)[\w\s,]{0,80} is strictly prohibited"),
]

# Short forms with a version.
SHORT = [
    ("gpl-1.0", "gpl", r"\bgpl(?:\s*|-)(?:version |v)?1(?:\.0)?(?![\w.]*\d)"),
    ("gpl-2.0", "gpl", r"\bgpl(?:\s*|-)(?:version |v\.? ?)?2(?:\.0)?(?![\w.+]*\d)(?!\+| or later|-or-later)"),
    ("gpl-3.0", "gpl", r"\bgpl(?:\s*|-)(?:version |v\.? ?)?3(?:\.0)?(?![\w.+]*\d)(?!\+| or later|-or-later)"),
    ("gpl-2.0-or-later", "gpl", r"\bgpl(?:\s*|-)(?:version |v\.? ?)?2(?:\.0)?(?:\+| or later|-or-later| or any later)"),
    ("gpl-3.0-or-later", "gpl", r"\bgpl(?:\s*|-)(?:version |v\.? ?)?3(?:\.0)?(?:\+| or later|-or-later| or any later)"),
    ("lgpl-2.0", "lgpl", r"\blgpl(?:\s*|-)(?:version |v\.? ?)?2(?:\.0)?(?![\w.+]*\d)(?!\+| or later|-or-later)"),
    ("lgpl-2.1", "lgpl", r"\blgpl(?:\s*|-)(?:version |v\.? ?)?2\.1(?!\+| or later|-or-later)"),
    ("lgpl-3.0", "lgpl", r"\blgpl(?:\s*|-)(?:version |v\.? ?)?3(?:\.0)?(?![\w.+]*\d)(?!\+| or later|-or-later)"),
    ("lgpl-2.1-or-later", "lgpl", r"\blgpl(?:\s*|-)(?:version |v\.? ?)?2\.1(?:\+| or later|-or-later| or any later)"),
    ("lgpl-3.0-or-later", "lgpl", r"\blgpl(?:\s*|-)(?:version |v\.? ?)?3(?:\.0)?(?:\+| or later|-or-later| or any later)"),
    ("agpl-3.0", "agpl", r"\bagpl(?:\s*|-)(?:version |v\.? ?)?3(?:\.0)?(?!\+| or later|-or-later)"),
    ("agpl-3.0-or-later", "agpl", r"\bagpl(?:\s*|-)(?:version |v\.? ?)?3(?:\.0)?(?:\+| or later|-or-later| or any later)"),
    ("apache-2.0", "apache", r"\bapache(?:\s+|-)(?:v|version )?2(?:\.0)?(?![\w.]*\d)"),
    ("apache-1.1", "apache", r"\bapache(?:\s+|-)(?:v|version )?1\.1"),
    ("apache-2.0", "asl", r"\basl(?:\s*|-)2(?:\.0)?(?![\w.]*\d)"),
    ("mpl-2.0", "mpl", r"\bmpl(?:\s*|-)(?:version |v\.? ?)?2(?:\.0)?(?![\w.]*\d)"),
    ("mpl-1.1", "mpl", r"\bmpl(?:\s*|-)(?:version |v\.? ?)?1\.1"),
    ("epl-1.0", "epl", r"\bepl(?:\s*|-)(?:version |v\.? ?)?1(?:\.0)?(?![\w.]*\d)"),
    ("epl-2.0", "epl", r"\bepl(?:\s*|-)(?:version |v\.? ?)?2(?:\.0)?(?![\w.]*\d)"),
    ("cddl-1.0", "cddl", r"\bcddl(?:\s*|-)(?:version |v\.? ?)?1\.0"),
    ("cddl-1.1", "cddl", r"\bcddl(?:\s*|-)(?:version |v\.? ?)?1\.1"),
    ("eupl-1.2", "eupl", r"\beupl(?:\s*|-)(?:v\.? ?)?1\.2"),
    ("bsl-1.0", "boost", r"\bboost (?:licen[cs]e )?1\.0"),
    ("ofl-1.1", "ofl", r"\bofl(?:\s*|-)(?:v\.? ?)?1\.1"),
    ("gpl", "gpl", r"\bgpl(?:'d|ed)?\b(?!(?:\s*|-)(?:version |v)?\d)"),
    ("lgpl", "lgpl", r"\blgpl\b(?!(?:\s*|-)(?:version |v)?\d)"),
    ("agpl", "agpl", r"\bagpl\b(?!(?:\s*|-)(?:version |v)?\d)"),
]

# Identifiers of license expressions beyond the labels of the rules above.
MORE_IDENTIFIERS = ["python-2.0", "bsd-3-clause-clear", "bsd-3-clause-lbnl", "mit-cmu", "gpl-2.0-with-classpath-exception",
                    "classpath-exception-2.0", "llvm-exception", "gcc-exception-3.1", "openssl-exception", "ecos-2.0",
                    "afl-3.0", "osl-3.0", "zpl-2.1", "lppl-1.3c", "cc-by-sa-3.0-us", "ntp", "naist-2003", "oldap-2.8"]
