"""Signatures of licences, over words in lower case with single spaces between."""

from __future__ import annotations

#: Base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Label, keyword and signature of sentences that only stand in a licence or its notice.
SENTENCES = (
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy(?: of this software)?"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", "neither the name of .{1,80}? nor the names of its contributors may be used to endorse"),
    ("gpl", "general public", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "lesser", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
    ("agpl", "affero", "gnu affero general public licen[cs]e(?: as published by the free software foundation)?"),
    ("mpl", "mozilla", "this source code form is subject to the terms of the mozilla public licen[cs]e(?: v 2 0)?"),
    ("apache", "in compliance", "you may not use this file except in compliance with the licen[cs]e"),
    ("unlicense", "public domain", "this is free and unencumbered software released into the public domain"),
    ("zlib", "warranty", "this software is provided as is without any express or implied warranty"),
    ("wtfpl", "what the", "do what the f[a-z]* you want to public licen[cs]e"),
    ("cc0", "dedicated", "has dedicated the work to the public domain"),
    ("proprietary", "reserved", "all rights reserved under licen[cs]e"),
)

#: Label, keyword, name and identifier. Each name makes a rule for each lead and place of "license".
NAMES = (
    ("gpl-3.0", "general public", "gnu general public licen[cs]e(?: gpl)? v(?:ersion)? ?3(?: 0)?(?: or later)?", "gpl 3 0(?: or later| only)?"),
    ("gpl-2.0", "general public", "gnu general public licen[cs]e(?: gpl)? v(?:ersion)? ?2(?: 0)?(?: or later)?", "gpl 2 0(?: or later| only)?"),
    ("gpl", "gpl", "(?:gnu )?gpl(?: ?v?[123](?: 0)?)?", ""),
    ("gpl", "general public", "gnu general public licen[cs]e", ""),
    ("lgpl-3.0", "lesser", "gnu lesser general public licen[cs]e v(?:ersion)? ?3(?: 0)?", "lgpl 3 0(?: or later| only)?"),
    ("lgpl-2.1", "lesser", "gnu lesser general public licen[cs]e v(?:ersion)? ?2 1", "lgpl 2 1(?: or later| only)?"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl(?: ?v?[23](?: [01])?)?", ""),
    ("agpl-3.0", "agpl", "(?:gnu )?agpl(?: ?v?3(?: 0)?)?", "agpl 3 0(?: or later| only)?"),
    ("apache-2.0", "apache", "apache(?: software)? licen[cs]e v(?:ersion)? ?2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", "apache(?: software)? licen[cs]e v(?:ersion)? ?1 1", "apache 1 1"),
    ("apache", "apache", "apache(?: software)? licen[cs]e", ""),
    ("mit", "mit", "mit(?: x11)?(?: expat)? licen[cs]e", "mit"),
    ("mit-0", "mit", "mit no attribution", "mit 0"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd)", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)", "bsd 4 clause"),
    ("0bsd", "bsd", "(?:zero clause bsd|0bsd)", "0bsd"),
    ("bsd", "bsd", "bsd", ""),
    ("isc", "isc", "isc", "isc"),
    ("mpl-2.0", "mozilla", "mozilla public licen[cs]e v(?:ersion)? ?2 0", "mpl 2 0"),
    ("mpl-1.1", "mozilla", "mozilla public licen[cs]e v(?:ersion)? ?1 1", "mpl 1 1"),
    ("mpl", "mpl", "mpl(?: ?v?[12](?: [01])?)?", ""),
    ("epl-2.0", "eclipse", "eclipse public licen[cs]e v(?:ersion)? ?2 0", "epl 2 0"),
    ("epl-1.0", "eclipse", "eclipse public licen[cs]e v(?:ersion)? ?1 0", "epl 1 0"),
    ("edl-1.0", "eclipse", "eclipse distribution licen[cs]e", "bsd 3 clause"),
    ("cddl-1.0", "common development", "common development and distribution licen[cs]e(?: cddl)?", "cddl 1 [01]"),
    ("eupl-1.2", "european union", "european union public licen[cs]e(?: v(?:ersion)? ?1 2)?", "eupl 1 [012]"),
    ("cc-by-4.0", "cc by|creative commons", "(?:cc by|creative commons attribution) 4 0(?: international)?", "cc by 4 0"),
    ("cc-by-3.0", "cc by|creative commons", "(?:cc by|creative commons attribution) 3 0(?: unported)?", "cc by 3 0"),
    ("cc-by-2.0", "cc by|creative commons", "(?:cc by|creative commons attribution) 2 [05](?: generic)?", "cc by 2 [05]"),
    ("cc-by-nc", "cc by|creative commons", "(?:cc by nc|creative commons attribution non ?commercial)(?: [1-4] [05])?", "cc by nc [1-4] [05]"),
    ("cc-by-sa", "cc by|creative commons", "(?:cc by sa|creative commons attribution share ?alike)(?: [1-4] [05])?", "cc by sa [1-4] [05]"),
    ("cc-by-nd", "cc by|creative commons", "(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)(?: [1-4] [05])?", "cc by nd [1-4] [05]"),
    ("cc-by-nc-sa", "cc by|creative commons", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1-4] [05])?", "cc by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "cc by|creative commons", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)(?: [1-4] [05])?", "cc by nc nd [1-4] [05]"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: [1-4] [05])?", ""),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: [1-4] [05])?", ""),
    ("cc-by", "creative commons", "creative commons attribution(?: [1-4] [05])?", ""),
    ("cc0-1.0", "cc0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("pddl", "public domain dedication", "(?:open data commons )?public domain dedication and licen[cs]e", "pddl 1 0"),
    ("odbl", "open database", "(?:open data commons )?open database licen[cs]e", "odbl 1 0"),
    ("odc-by", "open data commons", "open data commons attribution licen[cs]e", "odc by 1 0"),
    ("artistic-2.0", "artistic", "artistic licen[cs]e(?: v(?:ersion)?)? ?2 0", "artistic 2 0"),
    ("artistic-1.0", "artistic", "artistic licen[cs]e", "artistic 1 0"),
    ("boost-1.0", "boost", "boost software licen[cs]e(?: version)?(?: 1 0)?", "bsl 1 0"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("unlicense", "unlicen", "unlicen[cs]e", "unlicen[cs]e"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("ncsa", "open source licen", "(?:university of illinois )?(?:ncsa )?open source licen[cs]e", "ncsa"),
    ("psf-2.0", "python", "python software foundation licen[cs]e(?: version 2)?", "(?:psf|python) 2 0"),
    ("php-3.01", "php", "php licen[cs]e(?: version)?(?: 3 01?)?", "php 3 01?"),
    ("ruby", "ruby", "ruby", "ruby"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("ofl-1.1", "open font", "(?:sil )?open font licen[cs]e(?: version)?(?: 1 1)?", "ofl 1 [01]"),
    ("ms-pl", "microsoft public", "microsoft public licen[cs]e", "ms pl"),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal licen[cs]e", "ms rl"),
    ("osl-3.0", "open software", "open software licen[cs]e(?: 3 0)?", "osl 3 0"),
    ("afl-3.0", "academic free", "academic free licen[cs]e(?: version)?(?: 3 0)?", "afl 3 0"),
    ("cecill-2.1", "cecill", "cecill(?: [bc])?(?: 2 [01])?", "cecill [bc12](?: [01])?"),
    ("gfdl-1.3", "free documentation", "gnu free documentation licen[cs]e(?: version 1 [123])?", "gfdl 1 [123](?: or later| only)?"),
    ("blueoak-1.0.0", "blue oak", "blue oak model licen[cs]e(?: 1 0 0)?", "blueoak 1 0 0"),
    ("upl-1.0", "universal permissive", "universal permissive licen[cs]e(?: v 1 0)?", "upl 1 0"),
    ("vim", "vim", "vim", "vim"),
    ("w3c", "w3c", "w3c(?: software)?(?: notice)?", "w3c"),
    ("zpl-2.1", "zope", "zope public licen[cs]e", "zpl 2 1"),
    ("qpl-1.0", "public licen", "q(?:t)? ?public licen[cs]e", "qpl 1 0"),
    ("sspl-1.0", "server side", "server side public licen[cs]e", "sspl 1 0"),
    ("busl-1.1", "business source", "business source licen[cs]e(?: 1 1)?", "busl 1 1"),
    ("elastic-2.0", "elastic", "elastic licen[cs]e(?: 2 0)?", "elastic 2 0"),
    ("polyform", "polyform", "polyform (?:noncommercial|small business|strict)", "polyform [a-z]+ 1 0 0"),
    ("openrail", "openrail|open rail", "(?:creative ml |bigscience )?open ?rail(?: m)?", "openrail"),
    ("llama", "llama", "llama [23](?: [0-9])? community", ""),
)
