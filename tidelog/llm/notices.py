"""License notices: the words that name a license, and the words that make it another one."""

# Short notices, headers and full texts in common use, by SPDX name.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
    "binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission."
)


def _gnu(what: str, name: str, version: str) -> str:
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the "
        f"GNU {name} as published by the Free Software Foundation, either version {version} of the "
        "License, or (at your option) any later version."
    )


TEXTS = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0-or-later", _gnu("program", "Affero General Public License", "3")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", _BSD + _BSD_THIRD),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
     "License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
     "International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-or-later", _gnu("program", "General Public License", "2")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", _gnu("program", "General Public License", "3")),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission notice "
     "appear in all copies."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1-or-later", _gnu("library", "Lesser General Public License", "2.1")),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0-or-later", _gnu("library", "Lesser General Public License", "3")),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files, to deal in the Software without restriction."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software without "
     "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
     "Software is furnished to do so, subject to the following conditions: The above copyright notice and "
     "this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
     "v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free "
     "to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
     "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial "
     "applications, and to alter it and redistribute it freely, subject to the following restrictions: "
     "The origin of this software must not be misrepresented; you must not claim that you wrote the "
     "original software. Altered source versions must be plainly marked as such, and must not be "
     "misrepresented as being the original software. This notice may not be removed or altered from any "
     "source distribution."),
)
# Names that file tags give. A tag is exact, so it is a notice like any other.
TAGS = (
    "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0",
    "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
NOTICES = TEXTS + tuple((name, f"SPDX-License-Identifier: {name}") for name in TAGS)

# A notice with one of these words more or fewer is that of another license. So is one with
# other numbers, if there are any in its template; clauses may be numbered or not.
DECISIVE = frozenset(
    "mit bsd isc zlib apache mozilla mpl gnu gpl lgpl agpl cc cc0 creative commons unlicense spdx by nc sa "
    "nd attribution noncommercial sharealike noderivatives affero lesser library later only clause neither "
    "endorse promote advertising acknowledgement not non without noninfringement unencumbered".split()
)
