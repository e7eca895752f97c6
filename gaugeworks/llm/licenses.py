"""License scans: ordered signature rules over normalised words.

Words are lower-cased runs of ASCII letters and digits and of non-ASCII characters. Each rule is
a regular expression over the words joined by single blanks, gated by the words it cannot do
without: a document's words are looked up by hash, and only rules whose gate words it has all are
run. A gate word stands for its other spellings too (``SPELLINGS``). Of detections, one that lies inside the range of another of higher rank (priority, then
length, then order) is dropped. A fixed list of base phrases is always reported.

The rules are of two kinds: names of licenses with their versions and forms of notice, each
written by hand, which meet in a product; and sentences of license texts, headers and notices, each
written by hand, which need no name.

Null and empty texts have no words, no labels and score 0. Repeated rows and ids get a row each.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import pieces, query, table
from gaugeworks.llm.tokens import ALNUM, Words, split

# The base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Label; gate words; name pattern; SPDX words; versions ("" is any).
FAMILIES = (
    ("agpl", "affero license", "(?:gnu )?affero general public licen[sc]e", "agpl", "3 0,1 0,"),
    ("lgpl", "lesser license", "(?:gnu )?lesser general public licen[sc]e", "lgpl", "3 0,2 1,2 0,"),
    ("lgpl", "library license", "gnu library general public licen[sc]e", "lgpl", "2 0,"),
    ("gpl", "general license", "(?:gnu )?general public licen[sc]e", "gpl", "3 0,2 0,1 0,"),
    ("gfdl", "documentation license", "(?:gnu )?free documentation licen[sc]e", "gfdl", "1 3,1 2,1 1,"),
    ("apache", "apache", "apache (?:software )?licen[sc]e", "apache", "2 0,1 1,1 0,"),
    ("mit", "mit license", "(?:the )?mit licen[sc]e", "mit", ""),
    ("mit-0", "mit attribution", "mit no attribution", "mit 0", ""),
    ("bsd-2-clause", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd) licen[sc]e", "bsd 2 clause", ""),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd) licen[sc]e", "bsd 3 clause", ""),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd) licen[sc]e", "bsd 4 clause", ""),
    ("bsd", "bsd license", "bsd licen[sc]e", "bsd", ""),
    ("0bsd", "bsd", "(?:zero clause bsd|bsd zero clause)(?: licen[sc]e)?", "0bsd", ""),
    ("isc", "isc license", "isc licen[sc]e", "isc", ""),
    ("mpl", "mozilla license", "mozilla public licen[sc]e", "mpl", "2 0,1 1,1 0,"),
    ("epl", "eclipse license", "eclipse public licen[sc]e", "epl", "2 0,1 0,"),
    ("cddl", "distribution license", "common development and distribution licen[sc]e", "cddl", "1 1,1 0,"),
    ("cpl", "common license", "common public licen[sc]e", "cpl", "1 0,"),
    ("eupl", "european license", "european union public licen[sc]e", "eupl", "1 2,1 1,1 0,"),
    ("artistic", "artistic license", "artistic licen[sc]e", "artistic", "2 0,1 0,"),
    ("bsl", "boost license", "boost software licen[sc]e", "bsl", "1 0,"),
    ("busl", "business license", "business source licen[sc]e", "busl", "1 1,"),
    ("zlib", "zlib license", "zlib(?: libpng)? licen[sc]e", "zlib", ""),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense", ""),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl", ""),
    ("ofl", "sil license", "sil open font licen[sc]e", "ofl", "1 1,1 0,"),
    ("osl", "open license", "open software licen[sc]e", "osl", "3 0,2 1,"),
    ("afl", "academic license", "academic free licen[sc]e", "afl", "3 0,2 1,"),
    ("ms-pl", "microsoft license", "microsoft public licen[sc]e", "ms pl", ""),
    ("ms-rl", "microsoft license", "microsoft reciprocal licen[sc]e", "ms rl", ""),
    ("psf", "python license", "python software foundation licen[sc]e", "python", "2 0,"),
    ("php", "php license", "php licen[sc]e", "php", "3 01,3 0,"),
    ("ruby", "ruby license", "ruby licen[sc]e", "ruby", ""),
    ("postgresql", "postgresql license", "postgresql licen[sc]e", "postgresql", ""),
    ("openssl", "openssl license", "openssl licen[sc]e", "openssl", ""),
    ("sspl", "server license", "server side public licen[sc]e", "sspl", "1 0,"),
    ("elastic", "elastic license", "elastic licen[sc]e", "elastic", "2 0,"),
    ("ecl", "educational license", "educational community licen[sc]e", "ecl", "2 0,1 0,"),
    ("cc0", "cc0", "cc0", "cc0", "1 0,"),
    ("cc0", "creative zero", "creative commons (?:cc )?zero", "cc0", "1 0,"),
    ("cc-by", "cc by", "cc by", "cc by", "4 0,3 0,2 5,2 0,"),
    ("cc-by-sa", "cc by sa", "cc by sa", "cc by sa", "4 0,3 0,2 5,2 0,"),
    ("cc-by-nc", "cc by nc", "cc by nc", "cc by nc", "4 0,3 0,2 5,2 0,"),
    ("cc-by-nd", "cc by nd", "cc by nd", "cc by nd", "4 0,3 0,2 5,2 0,"),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa", "cc by nc sa", "4 0,3 0,2 5,"),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd", "cc by nc nd", "4 0,3 0,2 5,"),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike", "cc by sa", "4 0,3 0,"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial", "cc by nc", "4 0,3 0,"),
    ("cc-by", "creative commons", "creative commons attribution", "cc by", "4 0,3 0,"),
    ("odbl", "open database license", "open (?:data commons open )?database licen[sc]e", "odbl", "1 0,"),
    ("proprietary", "rights reserved", "all rights reserved", "licenseref proprietary", ""),
)

#: Forms of a notice: gate words, pattern with {name}, priority, confidence. Fixed values.
FORMS = (
    ("spdx identifier", "spdx license identifier (?:[^ ]+ ){{0,6}}?{spdx}", 100, 0.99),
    ("under", "(?:licensed|released|distributed|available|published|provided|covered|redistributed|used)(?: [^ ]+){{0,4}} under(?: [^ ]+){{0,4}} {name}", 80, 0.95),
    ("terms", "terms (?:and conditions )?of(?: [^ ]+){{0,3}} {name}", 70, 0.9),
    ("see", "see(?: [^ ]+){{0,3}} {name}", 60, 0.8),
    ("", "{name}", 50, 0.7),
)


#: Sentences of license texts: label; gate words; pattern. Fixed values. A sentence that several
#: licenses share has the label of the family, with "-style".
SENTENCES = (
    ("mit", "permission charge associated", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "substantial portions", "the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("mit", "holders liable", "in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("mit-style", "permission charge", "permission is hereby granted free of charge"),
    ("mit-style", "permission agreement", "permission is hereby granted without written agreement"),
    ("json", "good evil", "the software shall be used for good not evil"),
    ("x11-style", "advertising authorization", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization"),
    ("isc", "permission fee appear", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-style", "permission fee hereby", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("isc-style", "disclaims warranties", "the author disclaims all warranties with regard to this software"),
    ("hpnd", "permission supporting documentation", "that copyright notice and this permission notice appear in supporting documentation"),
    ("bsd-style", "redistribution binary", "redistribution and use in source and binary forms(?: of the software)?(?: as well as documentation)? with or without modification(?: are permitted)?"),
    ("bsd-style", "redistributions retain", "redistributions of source code must retain the(?: above)? copyright notice"),
    ("bsd-style", "redistributions reproduce", "redistributions in binary form must reproduce the(?: above)? copyright notice"),
    ("bsd-style", "express implied warranties", "this software is provided by the (?:copyright holders and contributors|regents and contributors|authors?) as is and any express or implied warranties"),
    ("bsd-3-clause", "endorse products", "neither the names? of(?: [^ ]+){1,20} (?:may|shall) be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("zlib", "altered misrepresented", "altered source versions must be plainly marked as such and must not be misrepresented"),
    ("zlib", "held arising", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("apache-2.0", "compliance license", "you may not use this (?:file|software|work) except in compliance with the licen[sc]e"),
    ("apache-2.0", "contributor worldwide", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("apache", "apache product", "this product includes software developed by the apache (?:software foundation|group)"),
    ("gpl", "redistribute modify general", "you can redistribute it and or modify it under the terms of(?: version [0-9]+(?: [0-9]+)? of)? the gnu general public licen[sc]e"),
    ("gpl", "received along general", "you should have received a copy of the gnu general public licen[sc]e along with"),
    ("lgpl", "redistribute modify lesser", "you can redistribute it and or modify it under the terms of(?: version [0-9]+(?: [0-9]+)? of)? the gnu lesser general public licen[sc]e"),
    ("lgpl", "redistribute modify library", "you can redistribute it and or modify it under the terms of(?: version [0-9]+(?: [0-9]+)? of)? the gnu library general public licen[sc]e"),
    ("agpl", "redistribute modify affero", "you can redistribute it and or modify it under the terms of(?: version [0-9]+(?: [0-9]+)? of)? the gnu affero general public licen[sc]e"),
    ("agpl-3.0", "interacting remotely", "all users interacting with it remotely through a computer network"),
    ("gpl-style", "distributed hope useful", "is distributed in the hope that it will be useful but without any warranty"),
    ("gpl-style", "verbatim copies", "everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document but changing it is not allowed"),
    ("gpl-style", "freedom share change", "the licen[sc]es for most software are designed to take away your freedom to share and change it"),
    ("gpl-style", "copyleft", "is a free copyleft licen[sc]e for software and other kinds of works"),
    ("gfdl", "invariant sections", "with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts"),
    ("mpl-2.0", "source subject mozilla", "this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("mpl-2.0", "incompatible secondary", "this source code form is incompatible with secondary licen[sc]es"),
    ("mpl", "contents subject", "the contents of this file are subject to the mozilla public licen[sc]e"),
    ("epl", "accompanying materials eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e"),
    ("cddl", "contents common development", "the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    ("bsl-1.0", "permission obtaining organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[sc]e"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "publish compile", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("cc0", "waived neighboring", "has waived all copyright and related or neighboring rights"),
    ("cc0", "affirmer waives", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("wtfpl", "fuck", "you just do what the fuck you want to"),
    ("beerware", "beer", "you can buy me a beer in return"),
    ("ofl-1.1", "font reserved", "no modified version of the font software may use the reserved font name s"),
    ("artistic", "semblance package", "the copyright holder maintains some semblance of artistic control over the development of the package"),
    ("openssl", "openssl product", "this product includes software developed by the openssl project"),
    ("ncsa", "deal restriction", "to deal with the software without restriction including without limitation the rights to use copy modify merge publish"),
    ("ms-pl", "accompanying accept", "this licen[sc]e governs use of the accompanying software if you use the software you accept this licen[sc]e"),
    ("public-domain", "public domain", "(?:released|placed|dedicated|is|are) (?:in|into|to) the public domain"),
    ("proprietary", "unauthorized prohibited", "unauthorized (?:copying|reproduction|use|distribution|duplication)(?: [^ ]+){0,12} is strictly prohibited"),
    ("proprietary", "confidential proprietary", "(?:is|are|contains?) (?:the )?(?:confidential and proprietary|proprietary and confidential)(?: information)?"),
    ("mit", "sublicense permit", "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"),
    ("mit", "noninfringement", "including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit-0", "furnished", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("mit-style", "deal restriction", "to deal in the software without restriction"),
    ("mit-style", "action contract tort", "whether in an action of contract tort or otherwise arising from out of or in connection with the software"),
    ("mit-cmu", "mellon publicity", "the name of carnegie mellon(?: university)? not be used in advertising or publicity"),
    ("x11", "consortium advertising", "except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("x11-style", "except contained notice", "except as contained in this notice the names? of(?: [^ ]+){1,12} shall not be used in advertising"),
    ("bsd-style", "liable exemplary", "in no event shall the (?:copyright (?:holders?|owner)(?: (?:and|or) contributors)?|regents or contributors|contributors) be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("bsd-style", "procurement substitute", "but not limited to procurement of substitute goods or services loss of use data or profits or business interruption"),
    ("bsd-style", "theory liability negligence", "on any theory of liability whether in contract strict liability or tort including negligence or otherwise"),
    ("bsd-style", "conditions disclaimer retain", "must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-style", "materials provided distribution", "the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-style", "found file", "use of this source code is governed by a bsd style licen[sc]e that can be found in the licen[sc]e file"),
    ("bsd-2-clause", "views conclusions", "the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted as representing official policies"),
    ("bsd-3-clause-clear", "express patent", "no express or implied licen[sc]es to any party s patent rights are granted by this licen[sc]e"),
    ("bsd-4-clause", "university california berkeley", "this product includes software developed by the university of california berkeley and its contributors"),
    ("bsd-4-clause", "product includes display", "must display the following acknowledge?ment this product includes software developed by"),
    ("bsd-1-clause", "redistributions source alone", "redistributions of source code alone must retain"),
    ("bsd-protection", "protection", "the bsd protection licen[sc]e"),
    ("apache-2.0", "distributed basis conditions", "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-2.0", "governing permissions limitations", "for the specific language governing permissions and limitations under the licen[sc]e"),
    ("apache-2.0", "asf contributor agreements", "licensed to the apache software foundation asf under one or more contributor licen[sc]e agreements"),
    ("apache-2.0", "notice regarding ownership", "see the notice file distributed with this work for additional information regarding copyright ownership"),
    ("apache-2.0", "licensor entity", "licensor shall mean the copyright owner or entity authorized by the copyright owner that is granting the licen[sc]e"),
    ("apache-2.0", "prominent modified files", "you must cause any modified files to carry prominent notices stating that you changed the files"),
    ("apache-2.0", "patent litigation terminate", "then any patent licen[sc]es granted to you under this licen[sc]e for that work shall terminate as of the date such litigation is filed"),
    ("apache-2.0", "attribution notices derivative", "in the source form of any derivative works that you distribute all copyright patent trademark and attribution notices from the source form of the work"),
    ("apache-1.1", "apache", "products derived from this software may not be called apache nor may apache appear in their name"),
    ("apache-1.0", "apache group", "redistributions of any form whatsoever must retain the following acknowledge?ment this product includes software developed by the apache group"),
    ("gpl-2.0-or-later", "either version option", "either version 2 of the licen[sc]e or at your option any later version"),
    ("gpl-3.0-or-later", "either version option foundation", "by the free software foundation either version 3 of the licen[sc]e or at your option any later version"),
    ("gpl-2.0", "boston foundation", "write to the free software foundation inc (?:51 franklin (?:street|st) fifth floor|59 temple place(?: suite 330)?) boston ma"),
    ("gpl-2.0", "mass ave cambridge", "free software foundation inc 675 mass ave cambridge ma"),
    ("gpl-2.0", "indicate modifying", "by modifying or distributing the program or any work based on the program you indicate your acceptance of this licen[sc]e"),
    ("gpl-2.0", "interactive announcement", "when started running for such interactive use in the most ordinary way to print or display an announcement"),
    ("gpl-2.0", "medium customarily interchange", "on a medium customarily used for software interchange"),
    ("gpl-3.0", "convey", "you may convey verbatim copies of the program s source code as you receive it in any medium"),
    ("gpl-3.0", "circumvention technological", "you waive any legal power to forbid circumvention of technological measures"),
    ("gpl-3.0", "installation user product", "installation information for a user product means any methods procedures authorization keys"),
    ("gpl-style", "merchantability fitness implied", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-style", "more details general", "see the gnu general public licen[sc]e for more details"),
    ("gpl-classpath", "linking modules", "linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gpl-classpath", "executable independent", "to link this library with independent modules to produce an executable regardless of the licen[sc]e terms of these independent modules"),
    ("gpl-gcc-exception", "runtime exception gcc", "gcc runtime library exception"),
    ("gpl-bison-exception", "bison parser skeleton", "as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("gpl-autoconf-exception", "autoconf script", "a configuration script generated by autoconf"),
    ("gpl-font-exception", "font embed", "if you create a document which uses this font and embed this font or unaltered portions of this font into the document"),
    ("linux-syscall-note", "kernel services calls", "this copyright does not cover user programs that use kernel services by normal system calls"),
    ("lgpl", "received copy lesser", "you should have received a copy of the gnu lesser general public licen[sc]e"),
    ("lgpl", "received copy library", "you should have received a copy of the gnu library general public licen[sc]e"),
    ("lgpl-2.1", "library", "work that uses the library with the library to produce a work containing portions of the library"),
    ("lgpl-3.0", "minimal corresponding", "convey the minimal corresponding source under the terms of this licen[sc]e"),
    ("lgpl-3.0", "incorporates supplemented permissions", "incorporates the terms and conditions of version 3 of the gnu general public licen[sc]e supplemented by the additional permissions"),
    ("agpl", "received copy affero", "you should have received a copy of the gnu affero general public licen[sc]e"),
    ("agpl-3.0", "prominently", "your modified version must prominently offer all users interacting with it"),
    ("gfdl", "permission document documentation", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e"),
    ("gfdl", "transparent opaque copy", "a copy that is not transparent is called opaque"),
    ("gfdl", "secondary section appendix", "a secondary section is a named appendix or a front matter section of the document"),
    ("mpl-1.1", "initial developer original", "the initial developer of the original code is"),
    ("mpl-1.1", "rights limitations basis", "software distributed under the licen[sc]e is distributed on an as is basis without warranty of any kind either express or implied see the licen[sc]e for the specific language governing rights and limitations"),
    ("mpl-2.0", "copy obtain", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2.0", "incompatible exhibit", "exhibit b incompatible with secondary licen[sc]es notice"),
    ("mpl-tri", "alternatively contents either", "alternatively the contents of this file may be used under the terms of either the gnu general public licen[sc]e"),
    ("npl", "netscape public", "the contents of this file are subject to the netscape public licen[sc]e"),
    ("epl", "secondary", "this source code may also be made available under the following secondary licen[sc]es"),
    ("epl-1.0", "recipient acceptance agreement", "any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement"),
    ("epl-2.0", "eclipse", "made available under the terms of the eclipse public licen[sc]e v(?:ersion)? ?2 0 which is available at"),
    ("edl-1.0", "eclipse distribution", "eclipse distribution licen[sc]e v(?:ersion)? ?1 0"),
    ("cpl-1.0", "common", "made available under the terms of the common public licen[sc]e"),
    ("ipl-1.0", "ibm public", "ibm public licen[sc]e version 1 0"),
    ("cddl-1.0", "cddl header", "when distributing covered code include this cddl header notice in each file"),
    ("cddl-1.0", "usr opensolaris", "you can obtain a copy of the licen[sc]e at usr src opensolaris licen[sc]e"),
    ("eupl", "licensed european approved", "licensed under the eupl version 1 [0-9]+ or as soon they will be approved by the european commission"),
    ("cecill", "cecill governed french", "this software is governed by the cecill(?: [bc])? licen[sc]e under french law"),
    ("cecill", "cea cnrs inria", "as circulated by cea cnrs and inria"),
    ("osl-3.0", "open licensed", "licensed under the open software licen[sc]e version 3 0"),
    ("afl-3.0", "academic free licensed", "licensed under the academic free licen[sc]e version 3 0"),
    ("artistic-1.0", "perl same terms", "you (?:can|may) redistribute it and or modify it under the same terms as perl itself"),
    ("artistic", "package", "you may distribute this package in aggregate with other possibly commercial programs"),
    ("bsl-1.0", "boost distributed accompanying", "distributed under the boost software licen[sc]e version 1 0 see accompanying file"),
    ("bsl-1.0", "machine executable object", "unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor"),
    ("zlib", "commercial applications alter", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("zlib", "appreciated documentation", "an acknowledge?ment in the product documentation would be appreciated but is not required"),
    ("zlib", "removed altered distribution", "this notice may not be removed or altered from any source distribution"),
    ("libpng", "contributing authors", "the contributing authors and group 42 inc disclaim all warranties"),
    ("libpng", "png reference library", "the png reference library is supplied as is"),
    ("ijg", "independent jpeg group", "this software is based in part on the work of the independent jpeg group"),
    ("libtiff", "silicon graphics publicity", "the names? of sam leffler and silicon graphics may not be used in any advertising or publicity"),
    ("curl", "copyright daniel stenberg", "copyright (?:c )?(?:[0-9]+ )?daniel stenberg"),
    ("freetype", "freetype portions", "portions of this software are copyright (?:c )?(?:[0-9]+ )?the freetype project"),
    ("unicode", "unicode data files", "permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("icu", "copyright permission supporting", "provided that the above copyright notice s and this permission notice appear in all copies of the software and that both the above copyright notice s and this permission notice appear in supporting documentation"),
    ("w3c", "obtaining copying", "by obtaining using and or copying this work you the licensee agree that you have read understood and will comply with the following terms"),
    ("ntp", "suitability", "makes no representations about the suitability (?:of )?this software for any purpose"),
    ("hpnd", "advertising publicity pertaining", "not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission"),
    ("hpnd-style", "permission fee granted", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("postgresql", "agreement paragraph", "without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies"),
    ("postgresql", "postgresql global development", "portions copyright (?:c )?(?:[0-9]+ )?(?:the )?postgresql global development group"),
    ("uc-style", "california", "the university of california has no obligations? to provide maintenance support updates enhancements or modifications"),
    ("ncsa", "illinois ncsa", "university of illinois ncsa open source licen[sc]e"),
    ("ncsa", "contributors", "neither the names of(?: [^ ]+){1,20} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission the software is provided"),
    ("llvm-exception", "llvm exceptions", "apache licen[sc]e(?: version| v)? ?v?2 0 with llvm exceptions"),
    ("python-2.0", "beopen", "beopen com is making this software available to licensee on an as is basis"),
    ("python-2.0", "psf nonexclusive", "psf hereby grants licensee a nonexclusive royalty free world ?wide licen[sc]e"),
    ("python-cnri", "cnri", "cnri is making python(?: [0-9]+)? available to licensee on an as is basis"),
    ("php-3.01", "php freely", "this product includes php software freely available from"),
    ("php-3.01", "php source", "this source file is subject to version 3 01 of the php licen[sc]e"),
    ("zend-2.0", "zend", "this source file is subject to version 2 00 of the zend licen[sc]e"),
    ("openssl", "cryptographic eric young", "this product includes cryptographic software written by eric young"),
    ("ssleay", "package", "this package is an ssl implementation written by eric young"),
    ("openldap", "openldap", "the openldap public licen[sc]e"),
    ("info-zip", "zip info", "for the purposes of this copyright and licen[sc]e info zip is defined as the following set of individuals"),
    ("bzip2", "bzip2", "this program bzip2 the associated library libbzip2"),
    ("vim", "vim charityware", "vim is charityware"),
    ("sqlite-blessing", "evil", "may you do good and not evil may you find forgiveness for yourself and forgive others"),
    ("sqlite-blessing", "disclaims blessing", "the author disclaims copyright to this source code in place of a legal notice here is a blessing"),
    ("unlicense", "jurisdictions recognize dedicate", "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest"),
    ("unlicense", "relinquishment perpetuity", "we intend this dedication to be an overt act of relinquishment in perpetuity"),
    ("cc0", "extent possible waived", "to the extent possible under law(?: [^ ]+){0,12} has waived all copyright"),
    ("cc0", "affirmer", "creates and or is the author of the work he or she is the affirmer"),
    ("cc", "creative commons corporation", "creative commons corporation is not a law firm and does not provide legal services"),
    ("cc", "restrict others technological", "you may not apply legal terms or technological measures that legally restrict others from doing anything the licen[sc]e permits"),
    ("cc-by", "appropriate credit indicate", "you must give appropriate credit provide a link to the licen[sc]e and indicate if changes were made"),
    ("cc-by-sa", "remix transform contributions", "if you remix transform or build upon the material you must distribute your contributions under the same licen[sc]e as the original"),
    ("cc-by-nc", "commercial purposes material", "you may not use the material for commercial purposes"),
    ("cc-by-nd", "remix modified distribute", "if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc-style", "licensed creative commons", "licensed under a creative commons(?: [^ ]+){0,4} (?:[0-9]+ [0-9]+ )?(?:international|unported|generic) licen[sc]e"),
    ("odbl", "database contents", "any rights in individual contents of the database are licensed under the database contents licen[sc]e"),
    ("pddl", "domain dedication", "public domain dedication and licen[sc]e pddl"),
    ("odc-by", "attribution data commons", "open data commons attribution licen[sc]e"),
    ("ogl-uk", "government information", "contains public sector information licensed under the open government licen[sc]e"),
    ("ofl-1.1", "font sold itself", "neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    ("ofl-1.1", "worldwide collaborative font", "the goals of the open font licen[sc]e ofl are to stimulate worldwide development of collaborative font projects"),
    ("ubuntu-font", "ubuntu font", "ubuntu font licen[sc]e version 1 0"),
    ("wtfpl", "verbatim modified changed name", "everyone is permitted to copy and distribute verbatim or modified copies of this licen[sc]e document and changing it is allowed as long as the name is changed"),
    ("beerware", "meet stuff worth", "if we meet some day and you think this stuff is worth it"),
    ("jsr-spec", "specification", "is hereby granted a fully paid non exclusive non transferable worldwide limited licen[sc]e under(?: [^ ]+){0,6} to use the specification"),
    ("ms-rl", "file", "for any file you distribute that contains code from the software in source code or binary format you must provide recipients the source code to that file"),
    ("ms-eula", "microsoft agreement terms", "these licen[sc]e terms are an agreement between microsoft corporation or based on where you live one of its affiliates and you"),
    ("sspl-1.0", "service functionality", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic-2.0", "hosted managed", "you may not provide the software to third parties as a hosted or managed service"),
    ("busl-1.1", "change date", "effective on the change date or the fourth anniversary of the first publicly available distribution"),
    ("busl-1.1", "production use licensor", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("commons-clause", "commons clause", "commons clause licen[sc]e condition"),
    ("commons-clause", "sell", "the right to sell the software for purposes of the foregoing sell means practicing any or all of the rights"),
    ("polyform-nc", "polyform noncommercial", "polyform noncommercial licen[sc]e"),
    ("polyform", "polyform", "polyform (?:strict|shield|perimeter|small business|internal use|free trial) licen[sc]e"),
    ("prosperity", "prosperity public", "the prosperity public licen[sc]e"),
    ("hippocratic", "hippocratic", "hippocratic licen[sc]e"),
    ("rail", "openrail", "(?:creativeml |bigscience )?openrail(?: m| d| s)? licen[sc]e"),
    ("llama-community", "llama community", "llama(?: [0-9]+)? community licen[sc]e agreement"),
    ("proprietary", "evaluation purposes only", "(?:licensed|provided|furnished) (?:solely |only )?for evaluation purposes only"),
    ("proprietary", "reverse engineer decompile", "you (?:may|shall|agree) not(?: to)? reverse engineer decompile or disassemble"),
    ("proprietary", "trade secrets", "contains? (?:the )?(?:valuable )?trade secrets"),
    ("proprietary", "internal use only", "for internal use only"),
    ("proprietary", "end user agreement", "end user licen[sc]e agreement"),
    ("proprietary", "permission reproduced", "no part of this (?:publication|work|book|document|software) may be reproduced(?: [^ ]+){0,20} without(?: [^ ]+){0,6} (?:written )?permission"),
    ("freeware", "freeware", "(?:this|the) (?:software|program) is freeware"),
    ("shareware", "shareware", "(?:this|the) (?:software|program) is shareware"),
    ("gpl-style", "charge third parties", "licensed as a whole at no charge to all third parties under the terms of this licen[sc]e"),
    ("artistic-2.0", "standard version restriction", "you are permitted to use the standard version and create and use modified versions for any purpose without restriction"),
    ("w3c", "trademarks publicity pertaining", "the name and trademarks of copyright holders may not be used in advertising or publicity pertaining to (?:this|the) (?:work|software) without specific written prior permission"),
    ("ruby", "clause bsdl", "you can redistribute it and or modify it under either the terms of the 2 clause bsdl"),
    ("ruby", "verbatim restriction", "you may make and give away verbatim copies of the source form of the software without restriction"),
    ("tcl", "grant documentation", "the authors hereby grant permission to use copy modify distribute and licen[sc]e this software and its documentation for any purpose"),
)

#: Words that open a gate as another word does: spellings that the patterns take as well.
SPELLINGS = {"licence": "license", "freebsd": "bsd"}


@dataclass(frozen=True)
class Rule:
    label: str
    gate: tuple[str, ...]
    pattern: re.Pattern
    priority: int
    confidence: float


def rules() -> tuple[Rule, ...]:
    """All signature rules, higher priority first; a named version outranks any version."""
    out = []
    for form_gate, form, priority, confidence in FORMS:
        for label, gate, name, spdx, versions in FAMILIES:
            for version in versions.split(","):
                number = f"(?: licen[sc]e)?(?: version| v)? v?{version.replace(' ', '(?: ')}{')?' * version.count(' ')}" if version else ""
                stem = spdx if "{spdx}" in form else name
                words = (set() if "{spdx}" in form else set(gate.split())) | set(form_gate.split())
                body = form.replace("{{", "{").replace("}}", "}").replace("{spdx}", stem + number).replace("{name}", stem + number)
                out.append(
                    Rule(
                        label + (f"-{version.replace(' ', '.')}" if version else ""),
                        tuple(sorted(words)),
                        re.compile(f"(?<= ){body}(?= )".encode()),
                        priority + (5 if version else 0),
                        confidence + (0.01 if version else 0.0),
                    )
                )
    for label, gate, body in SENTENCES:
        out.append(Rule(label, tuple(sorted(gate.split())), re.compile(f"(?<= ){body}(?= )".encode()), 65, 0.9))
    return tuple(sorted(out, key=lambda r: -r.priority))


def _hash(words: str) -> np.ndarray:
    return split(pa.array([words]), ALNUM).hashes()


class Scanner:
    def __init__(self):
        self.rules = rules()
        names = sorted({w for r in self.rules for w in r.gate} | set(SPELLINGS))
        hashes = np.concatenate([_hash(w) for w in names])
        order = np.argsort(hashes)
        self.gate_hashes, self.gate_words = hashes[order], [SPELLINGS.get(names[i], names[i]) for i in order]
        self.base = [(_hash(p), p.encode().split(), label) for p, label in BASE]

    def base_places(self, words: Words, hashes: np.ndarray) -> list[tuple[int, int, str]]:
        """(first word, number of words, label) of every place of a base phrase."""
        found = []
        for wanted, texts, label in self.base:
            n = len(wanted)
            if len(hashes) < n:
                continue
            here = np.ones(len(hashes) - n + 1, bool)
            for k in range(n):
                here &= hashes[k : len(hashes) - n + 1 + k] == wanted[k]
            at = np.flatnonzero(here)
            whole = words.first[np.searchsorted(words.first, at, "right")] >= at + n
            found += [(int(i), n, label) for i in at[whole] if [words.text(i + k) for k in range(n)] == texts]
        return sorted(found)

    def gates(self, words: Words, hashes: np.ndarray) -> dict[int, set[str]]:
        """The gate words of each text that has any."""
        at = np.searchsorted(self.gate_hashes, hashes)
        at[at == len(self.gate_hashes)] = 0
        hit = np.flatnonzero(self.gate_hashes[at] == hashes)
        owner = np.searchsorted(words.first, hit, "right") - 1
        out: dict[int, set[str]] = {}
        for key in np.unique(owner * len(self.gate_words) + at[hit]).tolist():
            d, w = divmod(key, len(self.gate_words))
            out.setdefault(d, set()).add(self.gate_words[w])
        return out

    def detect(self, words: Words, d: int, present: set[str]) -> list[tuple[int, int, str, float]]:
        """(first word, end, label, confidence) of the detections that stand in text d."""
        run = [r for r in self.rules if present.issuperset(r.gate)]
        if not run:
            return []
        a, b = int(words.first[d]), int(words.first[d + 1])
        text = b" " + b" ".join(words.text(i) for i in range(a, b)) + b" "
        blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        found = []
        for rank, rule in enumerate(run):
            for m in rule.pattern.finditer(text):
                i = int(np.searchsorted(blanks, m.start() - 1))
                j = int(np.searchsorted(blanks, m.end()))
                found.append((-rule.priority, i - j, rank, i, j, rule.label, rule.confidence))
        return contained_out([(i, j, label, c) for _, _, _, i, j, label, c in sorted(found)])


def contained_out(ranked: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """Of detections in order of rank, those not inside the range of one before. ``ranges``
    are those kept so far, none inside another, by start (and so by end too)."""
    kept, ranges = [], []
    for i, j, label, c in ranked:
        k = bisect_right(ranges, (i, float("inf")))
        if any(a <= i and j <= b for a, b in ranges[max(0, k - 1) : k]):
            continue
        kept.append((i, j, label, c))
        # drop ranges inside the new one, so that starts and ends stay in one order
        low = bisect_right(ranges, (i, -1))
        high = low
        while high < len(ranges) and ranges[high][1] <= j:
            high += 1
        ranges[low:high] = [(i, j)]
    return kept


_scanner: list[Scanner] = []


def _scan(batches):
    if not _scanner:
        _scanner.append(Scanner())
    scanner = _scanner[0]
    for batch in pieces(batches):
        words = split(batch.column("text"), ALNUM)
        hashes = words.hashes()
        counts = words.counts()
        places: dict[int, list] = {}
        for i, n, label in scanner.base_places(words, hashes):
            d = int(np.searchsorted(words.first, i, "right")) - 1
            places.setdefault(d, []).append((i - int(words.first[d]), n, label))
        gates = scanner.gates(words, hashes)
        rows = []
        for d in range(batch.num_rows):
            base = places.get(d, [])
            more = scanner.detect(words, d, gates[d]) if d in gates else []
            labels = {x[2] for x in base}
            starts = [x[0] for x in base]
            rows.append(
                (
                    int(counts[d]), len(base), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted(labels)), ",".join(sorted(labels | {x[2] for x in more})),
                    1.0 - float(np.prod([1 - x[3] for x in more])) if more else (0.7 if base else 0.0),
                    ",".join(f"{label}:{i}:{j}" for i, j, label, _ in sorted(more)),
                )
            )
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "evidence"],
        )


def license_labels(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to labels, a score (the chance that one detection at least is right, by
    the rules' confidences) and the detections as label:first word:end."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _scan,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, evidence string",
    )


@query("op9_licenses")
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents. The rules are beyond SQL; tests hold it against plain code."""
    return license_labels(table(spark, sf_dir, "documents"))
