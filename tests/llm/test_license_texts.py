"""Lines as a reader would label them, written apart from the rules; the second list names no license."""

from campaignry.llm import licenses

LABELLED = [
    ("SPDX-License-Identifier: GPL-2.0-only", "gpl-2"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2-or-later"),
    ("# SPDX-License-Identifier: MIT", "mit"),
    ("SPDX-License-Identifier: Apache-2.0", "apache-2"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("SPDX-License-Identifier: ISC", "isc"),
    ("SPDX-License-Identifier: AGPL-3.0-or-later", "agpl-3-or-later"),
    ("SPDX-License-Identifier: CC-BY-SA-4.0", "cc-by-sa"),
    ("Licensed under the GPL v3", "gpl-3"),
    ("released under GPLv2 or later", "gpl-2-or-later"),
    ("This file is GPL-3.0-only.", "gpl-3"),
    ("LGPL-2.1-or-later", "lgpl-2.1-or-later"),
    ("the library is LGPLv3", "lgpl-3"),
    ("MPL-2.0", "mpl-2"),
    ("AGPLv3", "agpl-3"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that", "bsd"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", "bsd-3-clause"),
    ("All advertising materials mentioning features or use of this software must display the following acknowledgement", "bsd-4-clause"),
    ("This program is free software; you can redistribute it and/or modify it", "gpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
     "Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gpl-3-or-later"),
    ("you may not use this file except in compliance with the License.", "apache-2"),
    ("Apache License v2.0", "apache-2"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that", "isc"),
    ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable", "zlib"),
    ("distributed under the Boost Software License, Version 1.0.", "bsl-1"),
    ("Eclipse Public License - v 2.0", "epl-2"),
    ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("https://creativecommons.org/licenses/by-nc-nd/4.0/", "cc-by-nc-nd"),
    ("CC BY-NC-SA 3.0", "cc-by-nc,cc-by-nc-sa"),  # the base phrase stays
    ("dedicated to the public domain under CC0 1.0 Universal", "cc0,public-domain"),
    ("The 3-Clause BSD License", "bsd-3-clause"),
    ("PostgreSQL Licence", "postgresql"),
    ("SIL Open Font License, Version 1.1", "ofl-1.1"),
    ("GNU Lesser General Public License v2.1", "lgpl-2.1"),
]
PLAIN = [
    "MIT 4.0 students", "see the ruby 2.0 release notes", "he studied at MIT in 1990", "apache 2.0 helicopters flew over", "the Apache web server 2.4",
    "a new driver license was issued", "license plate number 3", "my fishing licence expired", "free software is nice", "version 2.0 of the firmware",
    "python 3.0 was released", "the common public good", "a boost of 1.0 bar", "general public opinion", "open the vim editor", "zlib 1.2.11 compiled",
    "openssl 1.1 update", "mozilla firefox 2.0", "eclipse 3.0 of the sun", "an artistic 2.0 revolution", "php 3.0 to php 4.0", "x11 server 1.1",
    "permission is hereby granted to leave early", "the above copyright notice", "creative commons room in the library", "cc: by noon tomorrow",
    "bsd systems such as netbsd", "licensed physicians under the law", "the european union 1.1", "modified files: 3", "gnu is not unix", "gpl",
    "university of illinois", "a free document", "zope 2.1 server", "two clauses of the contract", "academic freedom 3.0",
]


def test_lines_are_labelled_as_a_reader_would(documents):
    lines = [(i, text) for i, (text, _) in enumerate(LABELLED)] + [(1000 + i, text) for i, text in enumerate(PLAIN)]
    got = {r["doc_id"]: r for r in licenses.license_scan(documents(lines)).collect()}
    assert len(LABELLED) > 30 and len(PLAIN) > 30
    assert {text: got[i]["labels"] for i, (text, _) in enumerate(LABELLED)} == dict(LABELLED)
    assert {text: got[1000 + i]["labels"] for i, text in enumerate(PLAIN)} == dict.fromkeys(PLAIN, "")
    assert all(got[i]["score"] > 0 for i in range(len(LABELLED))) and all(got[1000 + i]["score"] == 0 for i in range(len(PLAIN)))
