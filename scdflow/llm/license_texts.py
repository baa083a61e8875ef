"""What licenses are called and how their texts and standard headers are worded.

A template is found by its words; `name`, if any, must stand there as it is, and so must the
words of `must`.
"""

from __future__ import annotations

from typing import NamedTuple


class Template(NamedTuple):
    label: str
    text: str
    name: str = ""
    must: str = ""


MIT_BODY = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the Software), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, "
    "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions: The above copyright notice and this permission notice shall be included "
    "in all copies or substantial portions of the Software."
)
BSD_BODY = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: Redistributions of source "
    "code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
ISC_BODY = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted, provided that the above copyright notice and this "
    "permission notice appear in all copies."
)
UNLICENSE_BODY = (
    "This is free and unencumbered software released into the public domain. Anyone is free to "
    "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
    "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
    "any means."
)
ZLIB_BODY = (
    "Permission is granted to anyone to use this software for any purpose, including commercial "
    "applications, and to alter it and redistribute it freely, subject to the following "
    "restrictions: The origin of this software must not be misrepresented; you must not claim "
    "that you wrote the original software."
)
APACHE_HEADER = (
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at"
)
MPL_HEADER = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
    "copy of the MPL was not distributed with this file, You can obtain one at"
)
GNU_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU {} Public License as published by the Free Software Foundation, either version {} "
    "of the License, or (at your option) any later version."
)
#: Label, the words of the name, short name and version of the licenses of the GNU project.
GNU = [
    ("gpl-2", "General", "gpl", 2),
    ("gpl-3", "General", "gpl", 3),
    ("lgpl-2.1", "Lesser General", "lgpl", 2),
    ("lgpl-3", "Lesser General", "lgpl", 3),
    ("agpl-3", "Affero General", "agpl", 3),
]
#: Label, words of the name behind "Creative Commons Attribution", and of the short name.
CREATIVE_COMMONS = [
    ("cc-by", "", "cc by"),
    ("cc-by-sa", "ShareAlike", "cc by sa"),
    ("cc-by-nc", "NonCommercial", "cc by nc"),
    ("cc-by-nd", "NoDerivatives", "cc by nd"),
    ("cc-by-nc-sa", "NonCommercial ShareAlike", "cc by nc sa"),
    ("cc-by-nc-nd", "NonCommercial NoDerivatives", "cc by nc nd"),
]
#: Label and SPDX identifier.
SPDX = [
    ("mit", "MIT"),
    ("isc", "ISC"),
    ("apache-2", "Apache-2.0"),
    ("mpl-2", "MPL-2.0"),
    ("bsd", "BSD-2-Clause"),
    ("bsd", "BSD-3-Clause"),
    ("unlicense", "Unlicense"),
    ("zlib", "Zlib"),
]


def _gnu() -> list[Template]:
    found = []
    for label, words, short, version in GNU:
        name, must = f"GNU {words} Public License", f"{version}"
        found += [
            Template(label, f"{name} version {version}", name, must),
            Template(label, f"{name} {version}", name, must),
            Template(label, f"{name} v{version}", name, f"v{version}"),
            Template(label, GNU_HEADER.format(words, version), name, must),
            Template(label, f"{short}v{version}"),
            Template(label, f"{short} v{version}", f"{short} v{version}"),
            Template(label, f"{short} {version}", f"{short} {version}"),
        ]
    return found


def _creative_commons() -> list[Template]:
    found = []
    for label, words, short in CREATIVE_COMMONS:
        name = f"Creative Commons Attribution {words}"
        found.append(Template(label, f"{name} License", name))
        for version in (1, 2, 3, 4):
            found.append(Template(label, f"{name} {version}", name, f"{version}"))
            found.append(Template(label, f"{short} {version}", f"{short} {version}"))
    return [*found, Template("cc-by-nc", "cc by nc", "cc by nc")]


TEMPLATES = [
    Template("mit", "MIT License", "MIT License"),
    Template("mit", "MIT licensed", "MIT licensed"),
    Template("mit", MIT_BODY),
    Template("apache-2", "Apache License Version 2", "Apache License", "2"),
    Template("apache-2", "Apache License 2", "Apache License", "2"),
    Template("apache-2", "Apache License v2", "Apache License v2"),
    Template("apache-2", "Apache Software License 2", "Apache Software License", "2"),
    Template("apache-2", APACHE_HEADER, "Apache License", "2"),
    Template("mpl-2", "Mozilla Public License 2", "Mozilla Public License", "2"),
    Template("mpl-2", "Mozilla Public License v2", "Mozilla Public License v2"),
    Template("mpl-2", MPL_HEADER, "Mozilla Public License", "2"),
    Template("bsd", "BSD License", "BSD License"),
    Template("bsd", "BSD style License", "BSD style License"),
    Template("bsd", "BSD 2 Clause License", "BSD 2 Clause"),
    Template("bsd", "BSD 3 Clause License", "BSD 3 Clause"),
    Template("bsd", BSD_BODY),
    Template("isc", "ISC License", "ISC License"),
    Template("isc", ISC_BODY),
    Template("unlicense", UNLICENSE_BODY),
    Template("zlib", "zlib License", "zlib License"),
    Template("zlib", ZLIB_BODY),
    *_gnu(),
    *_creative_commons(),
    *(
        Template(label, f"SPDX License Identifier {name}", f"SPDX License Identifier {name}")
        for label, name in SPDX
    ),
    *(
        Template(label, f"SPDX License Identifier {short} {version}", f"Identifier {short} {version}")
        for label, _, short, version in GNU
    ),
]
