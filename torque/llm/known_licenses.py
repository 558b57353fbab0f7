"""Curated licence texts and notices for operator 2.

Whole texts are files of ``licenses/`` (most copied from Debian's
common-licenses); each is entered with and without its title, with and without
its appendix, and with the addresses and numberings it is handed out with.
Notices are sentences over the usual names of a licence, and SPDX lines.
"""

from __future__ import annotations

import re
from itertools import product
from pathlib import Path

FOLDER = Path(__file__).with_name("licenses")

# ---- fixed values ------------------------------------------------------------
# licence, file, where the text may start (besides its first line) and where it may stop
_GNU_END = ["END OF TERMS AND CONDITIONS", r"(Appendix: )?How to Apply These Terms"]
TEXTS = [
    ("Apache-2.0", "Apache-2.0", ["Version 2.0, January", "TERMS AND CONDITIONS FOR USE"],
     ["END OF TERMS AND CONDITIONS", "APPENDIX: How to apply", r"Copyright \[yyyy\]"]),
    ("Artistic-1.0-Perl", "Artistic", ["Preamble"], []),
    ("BSL-1.0", "BSL-1.0", ["Permission is hereby granted"], []),
    ("CC0-1.0", "CC0-1.0", ["CC0 1.0 Universal", "Statement of Purpose"], []),
    ("GPL-1.0", "GPL-1", ["Copyright", "Preamble"], _GNU_END),
    ("GPL-2.0", "GPL-2", ["Copyright", "Preamble"], _GNU_END),
    ("GPL-3.0", "GPL-3", ["Copyright", "Preamble"], _GNU_END),
    ("LGPL-2.0", "LGPL-2", ["Copyright", "Preamble"], _GNU_END),
    ("LGPL-2.1", "LGPL-2.1", ["Copyright", "Preamble"], _GNU_END),
    ("LGPL-3.0", "LGPL-3", ["Copyright", "This version of the GNU Lesser"], []),
    ("MPL-1.1", "MPL-1.1", [r"1\. Definitions"], ["EXHIBIT A"]),
    ("MPL-2.0", "MPL-2.0", [r"1\. Definitions"], ["Exhibit A - ", "Exhibit B - "]),
    ("GFDL-1.2", "GFDL-1.2", ["Copyright", r"0\. PREAMBLE"], ["ADDENDUM: "]),
    ("GFDL-1.3", "GFDL-1.3", ["Copyright", r"0\. PREAMBLE"], ["ADDENDUM: "]),
    ("BSD-3-Clause", "BSD", [], []),
    ("Unlicense", "Unlicense", [], ["For more information"]),
]
# Other wordings that texts are handed out with: (pattern, replacement) steps, each set
# entered besides the file's own wording.
_ADDRESS = r"51 Franklin St(reet)?, Fifth Floor, Boston,? MA\s+02110-1301,?\s+USA"
_SEE = r"write to the Free\s+Software\s+Foundation, Inc\.,\s+" + _ADDRESS
WORDINGS = [
    [(_ADDRESS, "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA")],
    [(_ADDRESS, "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA"),
     ("GNU Lesser General Public License instead", "GNU Library General Public License instead")],
    [(_ADDRESS, "675 Mass Ave, Cambridge, MA 02139, USA"),
     ("GNU Lesser General Public License instead", "GNU Library General Public License instead")],
    [(_SEE, "see <https://www.gnu.org/licenses/>"), (_ADDRESS, "<https://fsf.org/>"),
     ("signature of Ty Coon", "signature of Moe Ghoul")],
]
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)",
            "MIT", "License: MIT", "Expat License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "2-Clause BSD License",
                     "Simplified BSD License", 'BSD 2-Clause "Simplified" License',
                     "FreeBSD License", "BSD License", "The BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "3-Clause BSD License",
                     "New BSD License", "Modified BSD License", "Revised BSD License",
                     'BSD 3-Clause "New" or "Revised" License', "BSD License", "The BSD License"],
}
BSD_NAMES = ["copyright holder", "copyright holders", "author", "project", "organization",
             "University"]
NUMBERS = r"(?m)^\s*\d+\.\s+"

NAMES = {
    "MIT": ["MIT License", "MIT"],
    "ISC": ["ISC License", "ISC"],
    "0BSD": ["BSD Zero Clause License", "0BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License",
                     "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License",
                     "BSD-3-Clause"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0",
                   "Apache 2.0 License", "Apache 2.0"],
    "MPL-1.1": ["Mozilla Public License, version 1.1", "Mozilla Public License 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0",
                "Mozilla Public License, v. 2.0", "Mozilla Public License v2.0", "MPL 2.0"],
    "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
    "Unlicense": ["Unlicense"],
    "WTFPL": ["WTFPL"],
    "Zlib": ["zlib License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "EPL-1.0": ["Eclipse Public License, version 1.0", "Eclipse Public License 1.0",
                "Eclipse Public License v1.0"],
    "EPL-2.0": ["Eclipse Public License, version 2.0", "Eclipse Public License 2.0",
                "Eclipse Public License v2.0"],
    "EUPL-1.2": ["European Union Public Licence 1.2", "EUPL 1.2"],
    "Artistic-2.0": ["Artistic License 2.0"],
    "GFDL-1.3": ["GNU Free Documentation License, version 1.3"],
}
_GNU = [("GPL", "General", ["1.0", "2.0", "3.0"]), ("LGPL", "Lesser General", ["2.1", "3.0"]),
        ("LGPL", "Library General", ["2.0"]), ("AGPL", "Affero General", ["3.0"])]
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
       "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
SUBJECTS = ["", "This project is ", "This software is ", "This work is "]
VERBS = ["licensed", "released", "distributed"]
LINKS = ["under the", "under"]
SPDX = """MIT MIT-0 ISC 0BSD BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 Apache-1.1 Apache-2.0
MPL-1.1 MPL-2.0 CC0-1.0 Unlicense WTFPL Zlib EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 CDDL-1.0 CDDL-1.1
Artistic-1.0 Artistic-1.0-Perl Artistic-2.0 PostgreSQL Python-2.0 PSF-2.0 OFL-1.1 NCSA X11 curl
Libpng MS-PL MS-RL AFL-3.0 OSL-3.0 Ruby PHP-3.01 Vim Beerware BlueOak-1.0.0 MulanPSL-2.0 UPL-1.0
ODbL-1.0 ODC-By-1.0 PDDL-1.0""".split()
SENTENCES = [
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "All code is CC0 1.0"),
]
# ------------------------------------------------------------------------------


def _cuts(text: str, starts: list[str], stops: list[str]) -> list[str]:
    """The text from each start to each stop."""
    at = {0} | {m.start() for s in starts if (m := re.search(rf"(?m)^\W*{s}", text))}
    end = {len(text)}
    for stop in stops:
        found = list(re.finditer(rf"(?m)^\W*{stop}", text))
        end |= {found[-1].start()} if found else set()
    return [text[a:b] for a, b in product(sorted(at), sorted(end)) if a < b]


def _reworded(text: str) -> list[str]:
    out = [text]
    for steps in WORDINGS:
        other = text
        for seen, meant in steps:
            other = re.sub(seen, meant, other)
        out.append(other)
    return out


def whole_texts(short: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Variants of the filed texts and of ``short`` ones (licence, title and text)."""
    out = []
    for name, file, starts, stops in TEXTS:
        text = (FOLDER / f"{file}.txt").read_text(encoding="utf-8")
        if name == "BSD-3-Clause":
            bodies = [text, re.sub(NUMBERS, "", text)]
            out += [(name, t + b) for b in bodies for t in ("", *(f"{x}\n" for x in TITLES[name]))]
        else:
            out += [(name, cut) for other in _reworded(text) for cut in _cuts(other, starts, stops)]
    for name, text in short:
        body = text.split("\n", 1)[1]
        bodies = [body, body.replace("NONINFRINGEMENT", "NON-INFRINGEMENT"),
                  body.replace("and/or distribute", "and distribute"),
                  body.replace("OF MERCHANTABILITY, FITNESS", "OF MERCHANTABILITY AND FITNESS")]
        if name == "BSD-3-Clause":
            bodies = [body.replace("name of the copyright holder", f"name of the {x}")
                      for x in BSD_NAMES]
        bodies += [re.sub(NUMBERS, "", b) for b in bodies]
        out += [(name, t + b) for b in bodies for t in ("", *(f"{x}\n" for x in TITLES[name]))]
    return list(dict.fromkeys(out))


def _names() -> dict[str, list[str]]:
    out = {k: list(v) for k, v in NAMES.items()}
    for short, long, versions in _GNU:
        for v in versions:
            own = out.setdefault(f"{short}-{v}", [])
            later = out.setdefault(f"{short}-{v}-or-later", [])
            brief = v.removesuffix(".0")
            own += [f"GNU {long} Public License, version {brief}", f"GNU {long} Public License v{v}",
                    f"GNU {long} Public License v{brief}", f"{short}v{brief}", f"{short}-{v}",
                    f"GNU {short} v{brief}", f"{short}-{v}-only"]
            later += [f"GNU {long} Public License, version {brief} or later",
                      f"GNU {long} Public License, version {brief} or any later version",
                      f"GNU {long} Public License v{v} or later", f"{short}v{brief} or later",
                      f"{short}-{v}-or-later"]
    for (short, long), (v, scope) in product(_CC.items(), [("3.0", "Unported"),
                                                           ("4.0", "International")]):
        out[f"CC-{short}-{v}"] = [f"CC {short} {v}", f"Creative Commons {long} {v} {scope}",
                                  f"Creative Commons {long} {v} {scope} License"]
    return out


def notices() -> list[tuple[str, str]]:
    """(licence, line) of one-line notices and SPDX lines."""
    names = _names()
    out = list(SENTENCES)
    for licence, known in names.items():
        for name in known:
            out.append((licence, f"License: {name}"))
            out += [(licence, f"{s}{v} {by} {name}") for s, v, by in product(SUBJECTS, VERBS, LINKS)]
    for short, long, versions in _GNU:
        for v in versions:
            subject = "library" if short == "LGPL" else "program"
            out += [(f"{short}-{v}-or-later",
                     f"This {subject} is free software; you can redistribute it and/or modify it "
                     f"under the terms of the GNU {long} Public License as published by the Free "
                     f"Software Foundation; either version {v.removesuffix('.0')} of the License, "
                     "or (at your option) any later version.")]
            out += [(f"{short}-{v}", f"SPDX-License-Identifier: {short}-{v}{x}") for x in ("", "-only")]
            out.append((f"{short}-{v}-or-later", f"SPDX-License-Identifier: {short}-{v}-or-later"))
    ids = SPDX + [k for k in names if k.startswith(("CC-", "GFDL"))]
    out += [(x, f"SPDX-License-Identifier: {x}") for x in ids]
    return list(dict.fromkeys(out))
