"""Known licence texts beyond those of ``licences``: full texts, standard headers, notices, SPDX tags.

Full texts lie beside this file, a file per SPDX identifier. A full text, which ``only`` and
``or-later`` share, stands for ``only``. Everything is fixed and read on the driver.
"""

from __future__ import annotations

from pathlib import Path

FOLDER = Path(__file__).with_name("licence_texts")

# SPDX identifiers whose tag lines are known. "GPL-2.0+" and the like are left out, for
# the canonical form drops the plus sign.
TAGGED = """
0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BSD-1-Clause
BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-2.0 CC-BY-2.5
CC-BY-3.0 CC-BY-4.0 CC-BY-NC-2.0 CC-BY-NC-2.5 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0
CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0
CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.2-only GFDL-1.2-or-later
GFDL-1.3-only GFDL-1.3-or-later GPL-1.0-only GPL-1.0-or-later GPL-2.0-only GPL-2.0-or-later GPL-3.0-only
GPL-3.0-or-later ISC LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later
LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OSL-3.0 PostgreSQL PSF-2.0
Python-2.0 SSPL-1.0 Unlicense UPL-1.0 Vim WTFPL X11 ZPL-2.1 Zlib
""".split()

# Names in one-line notices.
NAMED = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, Version 2.0"],
    "ISC": ["ISC License"],
    "MIT": ["MIT License", "Expat License", "MIT"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License"],
}
GNU = [
    ("AGPL", "GNU Affero General Public License", ["3"]),
    ("GPL", "GNU General Public License", ["1", "2", "3"]),
    ("LGPL", "GNU Lesser General Public License", ["2.1", "3"]),
    ("LGPL", "GNU Library General Public License", ["2"]),
]
CREATIVE = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
OPENINGS = [
    "Licensed under the {}", "This work is licensed under the {}", "This project is licensed under the {}",
    "This software is licensed under the {}", "This code is licensed under the {}", "Released under the {}",
    "This software is released under the {}", "Distributed under the {}", "Available under the {}",
    "This program is licensed under the {}", "License: {}",
]
#: The MPL 2.0 header ("Exhibit A").
MPL_HEADER = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
)


def _full() -> list[tuple[str, str]]:
    out = []
    for file in sorted(FOLDER.glob("*.txt")):
        name, text = file.stem, file.read_text()
        out.append((name, text))
        end = text.find("END OF TERMS AND CONDITIONS")
        if end >= 0:  # without the appendix on how to apply it
            out += [(name, text[:end]), (name, text[: end + len("END OF TERMS AND CONDITIONS")])]
        if name == "Apache-2.0":  # with the appendix filled in, whose copyright line is then removed
            out.append((name, text.replace("Copyright [yyyy] [name of copyright owner]", "")))
        if name.startswith("BSD"):
            n = name.split("-")[1]
            points = text
            for k in "123":
                points = points.replace(f"\n{k}. ", "\n").replace(f" {k}. ", " ")
            titles = ["", f"BSD {n}-Clause License\n", f"The BSD {n}-Clause License\n", f"{n}-Clause BSD License\n"]
            rights = ["", "All rights reserved.\n"]
            out += [(name, t + r + body) for t in titles for r in rights for body in (text, points)]
    return out


def _gnu() -> list[tuple[str, str]]:
    out = []
    for short, long, versions in GNU:
        for version in versions:
            base = f"{short}-{version}" if "." in version else f"{short}-{version}.0"
            for form in (f"version {version}", f"version {version}.0", f"v{version}", f"v{version}.0"):
                for at in (f"{long}, {form}", f"{long} {form}"):
                    out += [(f"{base}-only", o.format(at)) for o in OPENINGS]
                    out += [(f"{base}-only", o.format(at) + " only") for o in OPENINGS]
                    out += [(f"{base}-or-later", o.format(at) + later) for o in OPENINGS
                            for later in (" or later", " or any later version", " or (at your option) any later version")]
            for what in ("program", "library", "file", "software"):
                head = (f"This {what} is free software: you can redistribute it and/or modify it under the terms of the "
                        f"{long} as published by the Free Software Foundation")
                rest = (f"This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
                        f"without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
                        f"See the {long} for more details.")
                got = (f"You should have received a copy of the {long} along with this {what}. If not, see "
                       "<http://www.gnu.org/licenses/>.")
                for suffix, version_text in (
                    ("or-later", f"either version {version} of the License, or (at your option) any later version."),
                    ("or-later", f"either version {version} of the License, or any later version."),
                    ("only", f"version {version} of the License."),
                    ("only", f"version {version}."),
                ):
                    first = f"{head}, {version_text}"
                    out += [(f"{base}-{suffix}", x) for x in (first, f"{first} {rest}", f"{first} {rest} {got}")]
    return out


def _creative() -> list[tuple[str, str]]:
    out = []
    for short, long in CREATIVE.items():
        names = [(v, f"Creative Commons {long} {v} {kind}") for v in ("2.0", "2.5", "3.0", "4.0")
                 for kind in (["International License", "International"] if v == "4.0" else ["Unported License", "Generic License"])]
        names += [(v, n) for v in ("2.0", "2.5", "3.0", "4.0")
                  for n in (f"CC {short} {v}", f"CC-{short}-{v}", f"CC {short} {v} License", f"Creative Commons {long} {v}",
                            f"Creative Commons {long} {v} License")]
        for version, name in names:
            for opening in OPENINGS:
                out += [(f"CC-{short}-{version}", opening.format(name))]
                out += [(f"CC-{short}-{version}", opening.replace("the {}", x).format(name)) for x in ("{}", "a {}")]
    return out


def known_texts() -> list[tuple[str, str]]:
    """(SPDX identifier, text) of all, without repeats."""
    out = [*_full(), *_gnu(), *_creative(), ("MPL-2.0", MPL_HEADER)]
    out += [(name, f"SPDX-License-Identifier: {name}") for name in TAGGED]
    out += [(name, o.format(x)) for name, names in NAMED.items() for x in names for o in OPENINGS]
    return list(dict.fromkeys(out))
