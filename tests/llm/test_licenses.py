"""Standard notices and the labels they must give."""

import pytest

from arbiter.llm import license_rules, license_scan

GNU = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation; {}"
ANY = "either version {} of the License, or (at your option) any later version."
NOTICES = [
    (GNU.format("General", ANY.format("2")), {"gpl", "gpl-2.0-or-later"}),
    (GNU.format("General", ANY.format("3")), {"gpl", "gpl-3.0-or-later"}),
    (GNU.format("General", "version 2 of the License."), {"gpl", "gpl-2.0"}),
    (GNU.format("Lesser General", ANY.format("2.1")), {"lgpl-2.1-or-later"}),
    (GNU.format("Library General", ANY.format("2")), {"lgpl-2.0-or-later"}),
    (GNU.format("Affero General", ANY.format("3")), {"agpl-3.0-or-later"}),
    ("under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation", {"gfdl-1.3-or-later"}),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file', {"apache", "apache-2.0"}),
    ("You may obtain a copy of the License at\n\n http://www.apache.org/licenses/LICENSE-2.0", {"apache-2.0"}),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", {"mpl-2.0"}),
    ("The contents of this file are subject to the Mozilla Public License Version 1.1", {"mpl-1.1"}),
    ("made available under the terms of the Eclipse Public License v1.0", {"epl-1.0"}),
    ("subject to the terms of the Common Development\n and Distribution License, Version 1.0", {"cddl-1.0"}),
    ("Common Public License Version 1.0", {"cpl-1.0"}),
    ("Licensed under the EUPL, Version 1.2 or later", {"eupl-1.2"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal\nin the Software without restriction, including without limitation the rights to use", {"mit"}),
    ("The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.", {"mit"}),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", {"isc"}),
    ("Redistributions of source code must retain the above copyright notice. Neither the name of the copyright holder nor the names of its\ncontributors may be used to endorse or promote products derived from this software", {"bsd", "bsd-3-clause"}),
    ("All advertising materials mentioning features or use of this software must display the following acknowledgement:", {"bsd-4-clause"}),
    ("obtaining a copy of the software and accompanying documentation covered by this license: Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", {"bsl-1.0"}),
    ("Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.", {"zlib"}),
    ("This is free and unencumbered software released into the public domain.", {"unlicense"}),
    ("The person who associated a work with this deed has dedicated the work to the public domain", {"cc0-1.0"}),
    ("https://creativecommons.org/licenses/by-sa/4.0/", {"cc-by-sa-4.0"}),
    ("Creative Commons Attribution-NonCommercial 4.0 International", {"cc-by-nc-4.0"}),
    ("This Font Software is licensed under the SIL Open Font License, Version 1.1.", {"ofl-1.1"}),
    ("for any purpose, without fee, and without a written agreement is hereby granted: and its documentation for any purpose, without fee, and without a written agreement is hereby granted", {"postgresql"}),
    ("University of Illinois/NCSA Open Source License", {"ncsa"}),
    ("The Software shall be used for Good, not Evil.", {"json"}),
    ("This product includes software developed by the OpenSSL Project", {"openssl"}),
    ("You just DO WHAT THE FUCK YOU WANT TO.", {"wtfpl"}),
    ("Server Side Public License, version 1", {"sspl-1.0"}),
    ("Business Source License 1.1", {"busl-1.1"}),
    ("Boost Software License - Version 1.0", {"bsl"}),
    ("BSD 3-Clause License", {"bsd-3-clause"}),
    ("the Python Software Foundation License Version 2", {"psf-2.0"}),
    ("Open Data Commons Attribution License", {"odc-by-1.0"}),
    ("SPDX-License-Identifier: GPL-2.0+", {"gpl-2.0-or-later"}),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause", {"mit", "apache-2.0", "bsd-3-clause"}),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", {"gpl-2.0-only", "classpath-exception-2.0"}),
    ("GPLv3", {"gpl-3.0"}), ("AGPLv3+", {"agpl-3.0-or-later"}), ("LGPL-2.1", {"lgpl-2.1"}), ("GPL version 2", {"gpl-2.0"}),
    ("an MIT-licensed library", {"mit"}), ("Apache 2.0", {"apache-2.0"}), ("GPL-2.0-or-later", {"gpl-2.0-or-later"}),
]
# labels that the notices must not give besides
WRONG = {"GPLv3": {"gpl-2.0", "gpl"}, "SPDX-License-Identifier: GPL-2.0+": {"gpl-2.0", "gpl"}, "AGPLv3+": {"gpl-3.0", "agpl-3.0"}}


@pytest.fixture(scope="module")
def scanner():
    return license_scan.Scanner()


@pytest.mark.parametrize("text,labels", NOTICES, ids=range(len(NOTICES)))
def test_notice(scanner, text, labels):
    for t in (text, text.upper(), text.replace(" ", "\n  ")) if "SPDX" not in text else (text, text.upper()):
        found = set(scanner.scan(t)[5].split(","))
        assert labels <= found, (t, found)
        assert not WRONG.get(text, set()) & found


def test_most_rules_are_written_by_hand():
    hand = license_rules.NOTICES + license_rules.SENTENCES + license_rules.NAMES + license_rules.SHORT
    assert len(hand) >= 200 and len({(label, e) for label, _, e in hand}) == len(hand)


@pytest.mark.parametrize("text", [
    "the summit-style licence", "commit licensed", "the apache tribe of version 2", "a public domain name", "spdx-license-identifier: none",
    "he gplayed 3 games", "mitigation licensed", "good, not evil"])
def test_ordinary_prose_has_no_label(scanner, text):
    assert scanner.scan(text)[5] == ""


def test_expressions_end_with_their_line(scanner):
    assert scanner.scan("SPDX-License-Identifier: MIT\nor Apache\n")[5] == "mit"
    assert scanner.scan("SPDX-License-Identifier: Unknown-1.0 OR ISC")[5] == "isc"
