"""Licence notices as a table: tags, one-line notices of the usual wordings, and the sentences that open the texts."""

from __future__ import annotations

#: Identifiers as they stand in a tag.
TAGS = (
    "0BSD", "AFL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "Artistic-2.0",
    "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0",
    "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0",
    "EUPL-1.2", "GFDL-1.3-or-later", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "MS-PL", "NCSA",
    "ODbL-1.0", "OFL-1.1", "OSL-3.0", "PostgreSQL", "Python-2.0", "Unlicense", "WTFPL", "Zlib",
)

#: Names in prose. Those that say enough by themselves stand alone, the others behind "under the".
NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License version 3", "GNU Affero General Public License v3"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "Artistic-2.0": ("Artistic License 2.0",),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "CC-BY-3.0": ("CC BY 3.0", "Creative Commons Attribution 3.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0"),
    "CC-BY-SA-3.0": ("CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"),
    "CC0-1.0": ("CC0 1.0 Universal", "Creative Commons Zero v1.0"),
    "EPL-1.0": ("Eclipse Public License 1.0", "Eclipse Public License - v 1.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License - v 2.0"),
    "EUPL-1.2": ("European Union Public Licence v. 1.2", "European Union Public License 1.2"),
    "GFDL": ("GNU Free Documentation License",),
    "GPL-2.0": ("GNU General Public License version 2", "GNU General Public License, v2", "GNU GPL version 2"),
    "GPL-3.0": ("GNU General Public License version 3", "GNU General Public License, v3", "GNU GPL version 3"),
    "LGPL-2.1": ("GNU Lesser General Public License version 2.1", "GNU Lesser General Public License v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License version 3", "GNU Lesser General Public License v3"),
    "MPL-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "Mozilla Public License Version 2.0"),
    "ODbL-1.0": ("Open Database License (ODbL) v1.0", "Open Data Commons Open Database License"),
    "OFL-1.1": ("SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"),
}
UNDER = {
    "Artistic": ("Artistic License",),
    "BSD": ("BSD License", "BSD-style license", "modified BSD license"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-clause BSD license", "simplified BSD license"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-clause BSD license"),
    "GPL": ("GNU General Public License", "GNU GPL"),
    "GPL-2.0": ("GPLv2", "GPL v2", "GPL-2.0"),
    "GPL-3.0": ("GPLv3", "GPL v3", "GPL-3.0"),
    "AGPL": ("GNU Affero General Public License", "GNU AGPL"),
    "AGPL-3.0": ("AGPLv3", "AGPL-3.0"),
    "ISC": ("ISC License",),
    "LGPL": ("GNU Lesser General Public License", "GNU LGPL"),
    "MIT": ("MIT License", "MIT licence", "Expat license"),
    "MPL": ("Mozilla Public License",),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib license",),
}

#: Fixed texts: sentences by which a licence's header or body is known.
BODIES = (
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
        "OF ANY KIND, either express or implied.",
    ),
    (
        "Apache-2.0",
        "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms "
        "and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so.",
    ),
    ("GPL", "under the terms of the GNU General Public License as published by"),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by"),
    ("AGPL", "under the terms of the GNU Affero General Public License as published by"),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
        "distribute, execute, and transmit the Software.",
    ),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"),
    (
        "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    ),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
)


def notices() -> tuple[tuple[str, str], ...]:
    """`template, text` of all: the template is the licence with the number of its notice behind a slash."""
    texts = [(tag, f"SPDX-License-Identifier: {tag}") for tag in TAGS]
    texts += [(name, text) for name, forms in NAMES.items() for text in forms]
    texts += [(name, f"under {article}{text}") for name, forms in UNDER.items() for text in forms for article in ("the ", "a ")]
    texts += BODIES
    count: dict[str, int] = {}
    out = []
    for name, text in texts:
        count[name] = count.get(name, 0) + 1
        out.append((f"{name}/{count[name]}", text))
    return tuple(out)
