"""Texts that license scans look for."""

from __future__ import annotations

from typing import NamedTuple


class Template(NamedTuple):
    """``kind`` "base" and "notice" must stand word for word; a "body" may have
    words changed, left out or put in."""

    label: str
    kind: str
    text: str


# Phrases and labels of the base scan.
BASE = [
    Template("gpl", "base", "gnu general public license"),
    Template("apache", "base", "apache license"),
    Template("cc-by", "base", "cc by"),
    Template("mit", "base", "mit license"),
]

# Usual one-line notices of public licenses.
NOTICES = [
    Template("agpl-3.0", "notice", "gnu affero general public license version 3"),
    Template("apache-2.0", "notice", "apache license version 2 0"),
    Template("bsd-2-clause", "notice", "bsd 2 clause license"),
    Template("bsd-3-clause", "notice", "bsd 3 clause license"),
    Template("cc-by-4.0", "notice", "cc by 4 0"),
    Template("cc-by-nc-4.0", "notice", "cc by nc 4 0"),
    Template("cc-by-nc-nd-4.0", "notice", "cc by nc nd 4 0"),
    Template("cc-by-nc-sa-4.0", "notice", "cc by nc sa 4 0"),
    Template("cc-by-nd-4.0", "notice", "cc by nd 4 0"),
    Template("cc-by-sa-4.0", "notice", "cc by sa 4 0"),
    Template("cc0-1.0", "notice", "cc0 1 0 universal"),
    Template("gpl-2.0", "notice", "gnu general public license version 2"),
    Template("gpl-3.0", "notice", "gnu general public license version 3"),
    Template("isc", "notice", "isc license"),
    Template("lgpl-2.1", "notice", "gnu lesser general public license version 2 1"),
    Template("lgpl-3.0", "notice", "gnu lesser general public license version 3"),
    Template("mpl-2.0", "notice", "mozilla public license version 2 0"),
]

# Passages of public licenses that stand in source files and
# at the foot of pages.
BODIES = [
    Template("mit", "body", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software."""),
    Template("isc", "body", """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies."""),
    Template("bsd-3-clause", "body", """
        Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission."""),
    Template("apache-2.0", "body", """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at"""),
    Template("gpl-2.0-or-later", "body", """
        This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or
        (at your option) any later version."""),
    Template("gpl-3.0-or-later", "body", """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version."""),
    Template("mpl-2.0", "body", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at"""),
    Template("unlicense", "body", """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means."""),
    Template("zlib", "body", """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to
        use this software for any purpose, including commercial applications, and to alter it and redistribute
        it freely"""),
]

TEMPLATES = BASE + NOTICES + BODIES
