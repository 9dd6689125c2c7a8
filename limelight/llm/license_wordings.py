"""Wordings of licenses and notices, each written down as one signature rule.

A row is (name, label, priority, weight, keyword, pattern, example). The pattern matches
whole words of the normal form of ``licenses``: letters lowered, punctuation as single
spaces. The keyword is in everything that the pattern matches. The example is a wording
that gets its label from this row alone.

Priorities: 95 sentences of a license, 88 its notice in a file, 72 names with a version,
55 other names, 45 what is said about rights without naming a license.
"""

from __future__ import annotations

WORDINGS = (
    # --- MIT and its relatives
    ("mit-text-notice", "mit", 95, 1.0, "substantial portions", r"this permission notice shall be included in all copies or substantial portions of the software", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit-text-deal", "mit", 95, 1.0, "deal in the software", r"to deal in the software without restriction", "to deal in the Software without restriction, including without limitation"),
    ("mit-text-rights", "mit", 95, 1.0, "sublicense and or sell", r"use copy modify merge publish distribute sublicense and or sell copies", "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies"),
    ("mit-text-permit", "mit", 95, 0.9, "furnished to do so", r"to permit persons to whom the software is (?:thereupon )?furnished to do so", "and to permit persons to whom the Software is furnished to do so"),
    ("mit-text-liable", "mit", 95, 0.9, "authors or copyright holders", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY"),
    ("mit-notice-style", "mit", 88, 0.8, "mit style", r"mit style licen[cs]e", "governed by an MIT-style license"),
    ("mit-notice-found", "mit", 88, 0.9, "opensource org licenses mit", r"opensource org licenses mit(?: license)?(?: php| html)?", "https://opensource.org/licenses/MIT"),
    ("mit-notice-dual", "mit", 88, 0.9, "mit", r"(?:dual|dually) licen[cs]ed (?:under )?(?:the )?mit", "Dual licensed MIT and GPL"),
    ("mit-header-field", "mit", 88, 0.9, "license mit", r"license mit", "\"license\": \"MIT\","),
    ("mit-expat", "mit", 55, 0.9, "expat", r"expat licen[cs]e", "the Expat licence"),
    ("mit-x11", "x11", 55, 0.9, "x11", r"(?:mit x11|x11) licen[cs]e", "under the X11 License"),
    ("x11-text", "x11", 95, 1.0, "x consortium", r"except as contained in this notice the name of the x consortium shall not be used in advertising", "Except as contained in this notice, the name of the X Consortium shall not be used in advertising"),
    ("mit-0-text", "mit-0", 95, 1.0, "no attribution", r"mit no attribution", "MIT No Attribution"),
    ("mit-0-name", "mit-0", 72, 1.0, "mit 0", r"mit 0(?: licen[cs]e)?", "MIT-0"),
    ("mit-modern", "mit-modern-variant", 95, 1.0, "without written agreement", r"without written agreement and without license or royalty fees to use copy modify and distribute", "permission is hereby granted, without written agreement and without license or royalty fees, to use, copy, modify, and distribute"),
    ("ncsa-text", "ncsa", 95, 1.0, "deal with the software", r"to deal with the software without restriction", "to deal with the Software without restriction"),
    ("ncsa-name", "ncsa", 55, 1.0, "ncsa", r"(?:university of illinois )?ncsa open source licen[cs]e", "University of Illinois/NCSA Open Source License"),
    ("curl-name", "curl", 55, 0.9, "curl licen", r"curl licen[cs]e", "the curl license"),
    ("hpnd-text", "hpnd", 95, 1.0, "supporting documentation", r"copyright notice and this permission notice appear in supporting documentation", "and that both that copyright notice and this permission notice appear in supporting documentation"),
    ("hpnd-name", "hpnd", 55, 1.0, "historical permission notice", r"historical permission notice and disclaimer", "Historical Permission Notice and Disclaimer"),
    ("isc-text-fee", "isc", 95, 0.9, "with or without fee is hereby granted", r"for any purpose with or without fee is hereby granted", "this software for any purpose with or without fee is hereby granted"),
    ("isc-text-warranty", "isc", 95, 0.9, "author disclaims all warranties", r"the author disclaims all warranties with regard to this software", "THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"),
    ("isc-header-field", "isc", 88, 0.9, "license isc", r"license isc", "License: ISC"),
    ("0bsd-name", "0bsd", 72, 1.0, "0bsd", r"0bsd", "0BSD"),
    ("0bsd-zero", "0bsd", 72, 1.0, "zero clause bsd", r"(?:bsd )?zero clause bsd", "Zero-Clause BSD"),
    # --- BSD
    ("bsd-text-source", "bsd", 95, 0.9, "redistributions of source code", r"redistributions of source code must retain the above copyright notice", "Redistributions of source code must retain the above copyright notice"),
    ("bsd-text-binary", "bsd", 95, 0.9, "redistributions in binary form", r"redistributions in binary form must reproduce the above copyright notice", "Redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-text-endorse", "bsd-3-clause", 95, 1.0, "endorse or promote", r"neither the name of (?:the )?\w+(?: \w+)? nor the names of its contributors may be used to endorse or promote", "Neither the name of Example nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-3-text-author", "bsd-3-clause", 95, 1.0, "name of the author may not be used", r"the name of the author may not be used to endorse or promote products", "The name of the author may not be used to endorse or promote products derived"),
    ("bsd-4-text-advertising", "bsd-4-clause", 95, 1.0, "advertising materials mentioning", r"all advertising materials mentioning features or use of this software must display", "All advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd-text-as-is", "bsd", 95, 0.9, "copyright holders and contributors as is", r"this software is provided by the copyright holders and contributors as is", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""),
    ("bsd-text-regents", "bsd", 95, 1.0, "by the regents", r"this software is provided by the regents and contributors", "THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS"),
    ("bsd-notice-under", "bsd", 88, 0.9, "under bsd", r"(?:licen[cs]ed|released|distributed) under bsd", "Distributed under BSD"),
    ("bsd-header-field", "bsd", 88, 0.9, "license bsd", r"license bsd", "License: BSD"),
    ("bsd-2-freebsd", "bsd-2-clause", 72, 0.9, "freebsd licen", r"freebsd licen[cs]e", "the FreeBSD license"),
    ("bsd-2-simplified", "bsd-2-clause", 72, 0.9, "simplified bsd", r"simplified bsd", "Simplified BSD"),
    ("bsd-3-new", "bsd-3-clause", 72, 0.9, "bsd", r"(?:new|revised|modified) bsd", "the Revised BSD"),
    ("bsd-3-words", "bsd-3-clause", 72, 0.9, "three clause", r"three clause bsd", "three-clause BSD"),
    ("bsd-2-words", "bsd-2-clause", 72, 0.9, "two clause", r"two clause bsd", "two-clause BSD"),
    ("bsd-4-original", "bsd-4-clause", 72, 0.9, "original bsd", r"original bsd licen[cs]e", "the original BSD license"),
    ("bsd-patents", "bsd-2-clause-patent", 72, 1.0, "plus patent", r"bsd (?:2 clause )?plus patent", "BSD-2-Clause Plus Patent"),
    ("bsd-clear", "bsd-3-clause-clear", 72, 1.0, "clear bsd", r"clear bsd licen[cs]e", "The Clear BSD License"),
    ("bsd-clear-text", "bsd-3-clause-clear", 95, 1.0, "no express or implied licenses to any party", r"no express or implied licenses to any party s patent rights are granted by this license", "NO EXPRESS OR IMPLIED LICENSES TO ANY PARTY'S PATENT RIGHTS ARE GRANTED BY THIS LICENSE"),
    # --- Apache
    ("apache-2-text-grant", "apache-2.0", 95, 1.0, "each contributor hereby grants to you a perpetual", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license", "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"),
    ("apache-2-text-terms", "apache-2.0", 95, 1.0, "terms and conditions for use reproduction", r"terms and conditions for use reproduction and distribution", "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("apache-2-text-as-is", "apache-2.0", 95, 0.9, "conditions of any kind", r"on an as is basis without warranties or conditions of any kind", "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("apache-2-text-notice", "apache-2.0", 95, 0.9, "notice text file", r"includes a notice text file as part of its distribution", "If the Work includes a \"NOTICE\" text file as part of its distribution"),
    ("apache-2-notice-url", "apache-2.0", 88, 1.0, "apache org licenses license 2 0", r"apache org licenses license 2 0", "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-notice-asf", "apache-2.0", 88, 1.0, "apache software foundation", r"licensed to the apache software foundation", "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements"),
    ("apache-2-header-field", "apache-2.0", 88, 0.9, "license apache 2", r"license apache 2(?: 0)?", "License: Apache-2.0"),
    ("apache-2-short", "apache-2.0", 72, 0.9, "apache", r"apache (?:v|version )?2(?: 0)?(?: licen[cs]ed?)", "Apache 2.0 licensed"),
    ("apache-1-text", "apache-1.1", 95, 1.0, "end user documentation included", r"the end user documentation included with the redistribution if any must include", "The end-user documentation included with the redistribution, if any, must include the following acknowledgment"),
    ("apache-2-llvm", "apache-2.0-llvm", 72, 1.0, "llvm exception", r"apache(?: license)? (?:v2 0 |2 0 )?with llvm exceptions?", "Apache 2.0 with LLVM Exception"),
    # --- GPL family
    ("gpl-text-freedom", "gpl", 95, 1.0, "take away your freedom", r"the licenses for most software (?:and other practical works )?are designed to take away your freedom", "The licenses for most software are designed to take away your freedom to share and change it."),
    ("gpl-text-hope", "gpl", 95, 0.9, "hope that it will be useful", r"distributed in the hope that it will be useful but without any warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    ("gpl-text-copyleft", "gpl", 95, 1.0, "copyleft license for software", r"is a free copyleft license for software and other kinds of works", "is a free, copyleft license for software and other kinds of works"),
    ("gpl-text-verbatim", "gpl", 95, 0.9, "changing it is not allowed", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("gpl-2-text-activities", "gpl-2", 95, 1.0, "activities other than copying", r"activities other than copying distribution and modification are not covered by this license", "Activities other than copying, distribution and modification are not covered by this License"),
    ("gpl-2-text-work", "gpl-2", 95, 1.0, "work based on the program", r"a work based on the program means", "a \"work based on the Program\" means either the Program"),
    ("gpl-2-text-notices", "gpl-2", 95, 1.0, "files to carry prominent notices", r"cause the modified files to carry prominent notices", "You must cause the modified files to carry prominent notices stating that you changed the files"),
    ("gpl-3-text-propagate", "gpl-3", 95, 1.0, "to propagate a work", r"to propagate a work means to do anything with it that without permission", "To \"propagate\" a work means to do anything with it that, without permission"),
    ("gpl-3-text-convey", "gpl-3", 95, 1.0, "to convey a work", r"to convey a work means any kind of propagation", "To \"convey\" a work means any kind of propagation that enables other parties"),
    ("gpl-3-text-tivo", "gpl-3", 95, 1.0, "installation information for a user", r"installation information for a user product means", "\"Installation Information\" for a User Product means any methods"),
    ("gpl-notice-temple", "gpl", 88, 0.8, "temple place", r"free software foundation inc 59 temple place", "write to the Free Software Foundation, Inc., 59 Temple Place"),
    ("gpl-notice-franklin", "gpl", 88, 0.8, "franklin st", r"free software foundation inc 51 franklin st(?:reet)?", "Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor"),
    ("gpl-notice-mass", "gpl", 88, 0.8, "675 mass", r"free software foundation inc 675 mass ave", "Free Software Foundation, Inc., 675 Mass Ave, Cambridge"),
    ("gpl-2-short", "gpl-2", 72, 0.9, "gplv2", r"gplv2", "GPLv2"),
    ("gpl-2-plus", "gpl-2-or-later", 72, 0.9, "gpl", r"gpl ?v2 (?:or later|or newer|or any later version)|gplv2 or later", "GPLv2 or later"),
    ("gpl-3-short", "gpl-3", 72, 0.9, "gplv3", r"gplv3", "GPLv3"),
    ("gpl-3-plus", "gpl-3-or-later", 72, 0.9, "gplv3", r"gplv3 or (?:any )?(?:later|newer)", "GPLv3 or later"),
    ("gpl-classpath", "gpl-classpath-exception", 88, 1.0, "classpath exception", r"classpath exception", "subject to the \"Classpath\" exception"),
    ("gpl-classpath-text", "gpl-classpath-exception", 95, 1.0, "regardless of the license terms of these independent modules", r"to produce an executable regardless of the license terms of these independent modules", "to produce an executable, regardless of the license terms of these independent modules"),
    ("gpl-gcc-exception", "gcc-runtime-exception", 88, 1.0, "gcc runtime library exception", r"gcc runtime library exception", "GCC Runtime Library Exception"),
    ("gpl-bison-exception", "bison-exception", 95, 1.0, "bison parser skeleton", r"part or all of the bison parser skeleton", "that contains part or all of the Bison parser skeleton"),
    ("gpl-font-exception", "gpl-font-exception", 95, 1.0, "embed this font", r"if you create a document which uses this font and embed this font", "if you create a document which uses this font, and embed this font"),
    ("gpl-openssl-exception", "openssl-exception", 95, 1.0, "openssl library", r"permission to link the code of (?:portions of )?this program with the openssl library", "permission to link the code of portions of this program with the OpenSSL library"),
    ("linux-syscall-note", "linux-syscall-note", 95, 1.0, "user programs that use kernel services", r"does not cover user programs that use kernel services by normal system calls", "This copyright does not cover user programs that use kernel services by normal system calls"),
    ("lgpl-text-library", "lgpl", 95, 1.0, "this library is free software", r"this library is free software you can redistribute it and or modify", "This library is free software; you can redistribute it and/or modify it"),
    ("lgpl-text-combined", "lgpl-3", 95, 1.0, "combined work is a work", r"a combined work is a work produced by combining or linking an application with the library", "A \"Combined Work\" is a work produced by combining or linking an Application with the Library"),
    ("lgpl-2-text-uses", "lgpl-2.1", 95, 1.0, "work that uses the library", r"work that uses the library", "such a work is called a \"work that uses the Library\""),
    ("lgpl-short", "lgpl", 72, 0.9, "lgplv", r"lgplv\d", "LGPLv3"),
    ("lgpl-words", "lgpl", 55, 0.9, "lesser gpl", r"lesser gpl", "the Lesser GPL"),
    ("agpl-text-network", "agpl-3", 95, 1.0, "remotely through a computer network", r"all users interacting with it remotely through a computer network", "all users interacting with it remotely through a computer network"),
    ("agpl-short", "agpl-3", 72, 0.9, "agplv3", r"agplv3", "AGPLv3"),
    ("agpl-words", "agpl", 55, 0.9, "affero", r"affero (?:gpl|general public licen[cs]e)", "the Affero GPL"),
    ("sspl-name", "sspl-1.0", 72, 1.0, "server side public", r"server side public licen[cs]e", "Server Side Public License"),
    ("sspl-text", "sspl-1.0", 95, 1.0, "service source code", r"you must make the service source code available", "you must make the Service Source Code available via network download"),
    ("gfdl-text", "gfdl", 95, 1.0, "no invariant sections", r"with no invariant sections no front cover texts and no back cover texts", "with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts"),
    ("gfdl-text-purpose", "gfdl", 95, 1.0, "functional and useful document", r"to make a manual textbook or other functional and useful document free", "to make a manual, textbook, or other functional and useful document \"free\""),
    # --- other copyleft
    ("mpl-2-text-form", "mpl-2.0", 95, 1.0, "source code form", r"this source code form is subject to the terms of the mozilla public license", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("mpl-2-text-incompatible", "mpl-2.0", 95, 1.0, "incompatible with secondary licenses", r"incompatible with secondary licenses", "This is \"Incompatible With Secondary Licenses\""),
    ("mpl-1-text", "mpl-1.1", 95, 1.0, "contents of this file are subject to the mozilla", r"the contents of this file are subject to the mozilla public license", "The contents of this file are subject to the Mozilla Public License"),
    ("epl-text", "epl", 95, 1.0, "this program and the accompanying materials", r"this program and the accompanying materials are made available under the terms of the eclipse", "This program and the accompanying materials are made available under the terms of the Eclipse"),
    ("edl-name", "bsd-3-clause", 72, 0.9, "eclipse distribution", r"eclipse distribution licen[cs]e", "Eclipse Distribution License"),
    ("ibmpl-name", "ipl-1.0", 55, 1.0, "ibm public", r"ibm public licen[cs]e", "IBM Public License"),
    ("qpl-name", "qpl", 55, 1.0, "public licen", r"q public licen[cs]e", "The Q Public License"),
    ("apsl-name", "apsl", 55, 1.0, "apple public source", r"apple public source licen[cs]e", "Apple Public Source License"),
    ("spl-name", "sun-public", 55, 1.0, "sun public", r"sun public licen[cs]e", "Sun Public License"),
    ("cecill-name", "cecill", 55, 1.0, "cecill", r"cecill(?: b| c)?(?: licen[cs]e)?", "CeCILL-B"),
    ("cecill-text", "cecill", 95, 1.0, "cea cnrs and inria", r"as circulated by cea cnrs and inria", "as circulated by CEA, CNRS and INRIA"),
    ("ms-rl-name", "ms-rl", 55, 1.0, "microsoft reciprocal", r"microsoft reciprocal licen[cs]e", "Microsoft Reciprocal License"),
    ("ms-pl-short", "ms-pl", 55, 0.9, "ms pl", r"ms pl", "MS-PL"),
    ("cpal-name", "cpal-1.0", 55, 1.0, "common public attribution", r"common public attribution licen[cs]e", "Common Public Attribution License"),
    ("rpl-name", "rpl", 55, 1.0, "reciprocal public", r"reciprocal public licen[cs]e", "Reciprocal Public License"),
    ("parity-name", "parity", 55, 0.9, "parity public", r"parity public licen[cs]e", "The Parity Public License"),
    ("oclc-name", "oclc-2.0", 55, 0.9, "oclc research public", r"oclc research public licen[cs]e", "OCLC Research Public License"),
    ("sleepycat-name", "sleepycat", 55, 1.0, "sleepycat licen", r"sleepycat licen[cs]e", "The Sleepycat License"),
    ("sleepycat-text", "sleepycat", 95, 1.0, "how to obtain complete source code", r"accompanied by information on how to obtain complete source code", "must be accompanied by information on how to obtain complete source code"),
    # --- other permissive
    ("zlib-text-origin", "zlib", 95, 1.0, "must not be misrepresented", r"the origin of this software must not be misrepresented", "The origin of this software must not be misrepresented"),
    ("zlib-text-altered", "zlib", 95, 1.0, "altered source versions", r"altered source versions must be plainly marked as such", "Altered source versions must be plainly marked as such"),
    ("zlib-text-express", "zlib", 95, 0.9, "express or implied warranty", r"provided as is without any express or implied warranty", "This software is provided 'as-is', without any express or implied warranty."),
    ("libpng-name", "libpng", 55, 1.0, "png reference library", r"png reference library licen[cs]e", "PNG Reference Library License"),
    ("boost-text", "bsl-1.0", 95, 1.0, "machine executable object code", r"solely in the form of machine executable object code generated by a source language processor", "solely in the form of machine-executable object code generated by a source language processor"),
    ("boost-url", "bsl-1.0", 88, 1.0, "boost org license 1 0", r"boost org license 1 0(?: txt)?", "http://www.boost.org/LICENSE_1_0.txt"),
    ("psf-text", "python", 95, 1.0, "psf is making python available", r"psf is making python available to licensee on an as is basis", "PSF is making Python available to Licensee on an \"AS IS\" basis"),
    ("psf-short", "python", 55, 0.9, "psf licen", r"psf licen[cs]e", "the PSF license"),
    ("artistic-2-text", "artistic-2.0", 95, 1.0, "artistic control", r"copyright holder maintains some (?:sort of |semblance of )?artistic control", "such that the Copyright Holder maintains some semblance of artistic control"),
    ("perl-terms", "artistic-or-gpl", 88, 1.0, "same terms as perl", r"under the same terms as perl(?: itself)?", "redistribute it and/or modify it under the same terms as Perl itself"),
    ("ruby-name", "ruby", 55, 0.9, "ruby", r"(?:the ruby licen[cs]e|same terms as ruby)", "same terms as Ruby"),
    ("php-text", "php", 95, 1.0, "derived from this software may not be called php", r"products derived from this software may not be called php", "Products derived from this software may not be called \"PHP\""),
    ("openssl-text", "openssl", 95, 1.0, "openssl project for use", r"developed by the openssl project for use in the openssl toolkit", "This product includes software developed by the OpenSSL Project for use in the OpenSSL Toolkit"),
    ("openssl-name", "openssl", 55, 0.9, "openssl licen", r"openssl licen[cs]e", "the OpenSSL license"),
    ("ssleay-text", "openssl", 95, 1.0, "written by eric young", r"cryptographic software written by eric young", "This product includes cryptographic software written by Eric Young"),
    ("w3c-name", "w3c", 55, 1.0, "w3c software", r"w3c software (?:notice and )?(?:and document )?licen[cs]e", "W3C Software Notice and License"),
    ("unicode-text", "unicode", 95, 1.0, "unicode data files", r"a copy of the unicode data files and any associated documentation", "any person obtaining a copy of the Unicode data files and any associated documentation"),
    ("unicode-name", "unicode", 55, 0.9, "unicode licen", r"unicode licen[cs]e", "Unicode License v3"),
    ("icu-name", "icu", 55, 0.9, "icu licen", r"icu licen[cs]e", "ICU License"),
    ("ijg-text", "ijg", 95, 1.0, "independent jpeg group", r"based in part on the work of the independent jpeg group", "this software is based in part on the work of the Independent JPEG Group"),
    ("freetype-text", "ftl", 95, 1.0, "freetype", r"portions of this software are copyright (?:c |© )?(?:\d\d\d\d )?the freetype project", "Portions of this software are copyright © 2020 The FreeType Project"),
    ("freetype-name", "ftl", 55, 1.0, "freetype", r"freetype (?:project )?licen[cs]e", "The FreeType Project LICENSE"),
    ("postgres-name", "postgresql", 55, 1.0, "postgresql licen", r"postgresql licen[cs]e", "The PostgreSQL License"),
    ("postgres-text", "postgresql", 95, 0.9, "without a written agreement is hereby granted", r"without fee and without a written agreement is hereby granted", "for any purpose, without fee, and without a written agreement is hereby granted"),
    ("tcl-text", "tcl", 95, 1.0, "scriptics corporation", r"regents of the university of california sun microsystems inc scriptics corporation", "Regents of the University of California, Sun Microsystems, Inc., Scriptics Corporation"),
    ("tcl-name", "tcl", 55, 0.9, "tcl tk licen", r"tcl tk licen[cs]e", "Tcl/Tk license"),
    ("vim-text", "vim", 95, 1.0, "vim is charityware", r"vim is charityware", "Vim is Charityware."),
    ("beerware", "beerware", 95, 1.0, "buy me a beer", r"(?:you can )?buy me a beer in return", "you think this stuff is worth it, you can buy me a beer in return"),
    ("beerware-name", "beerware", 55, 1.0, "beer", r"(?:the )?beer ?ware licen[cs]e", "THE BEER-WARE LICENSE (Revision 42)"),
    ("blueoak-name", "blueoak-1.0.0", 55, 1.0, "blue oak model", r"blue oak model licen[cs]e", "Blue Oak Model License"),
    ("upl-name", "upl-1.0", 55, 1.0, "universal permissive", r"universal permissive licen[cs]e", "Universal Permissive License"),
    ("mulan-name", "mulanpsl", 55, 1.0, "mulan", r"mulan (?:psl|permissive software licen[cs]e)", "Mulan PSL v2"),
    ("json-text", "json", 95, 1.0, "good not evil", r"shall be used for good not evil", "The Software shall be used for Good, not Evil."),
    ("ofl-text", "ofl", 95, 1.0, "reserved font name", r"with reserved font names?", "with Reserved Font Name Example"),
    ("ofl-text-sold", "ofl", 95, 1.0, "sold by itself", r"nor any of its individual components (?:in original or modified versions )?may be sold by itself", "Neither the Font Software nor any of its individual components, in Original or Modified Versions, may be sold by itself."),
    ("ofl-url", "ofl", 88, 1.0, "scripts sil org ofl", r"scripts sil org ofl", "http://scripts.sil.org/OFL"),
    ("ubuntu-font", "ubuntu-font", 55, 1.0, "ubuntu font", r"ubuntu font licen[cs]e", "Ubuntu Font Licence"),
    ("bitstream-vera", "bitstream-vera", 95, 1.0, "bitstream vera", r"bitstream vera is a trademark of bitstream", "Bitstream Vera is a trademark of Bitstream, Inc."),
    ("lppl-name", "lppl", 55, 1.0, "latex project public", r"latex project public licen[cs]e", "LaTeX Project Public License"),
    ("lppl-short", "lppl", 55, 0.9, "lppl", r"lppl", "LPPL"),
    ("wtfpl-text", "wtfpl", 95, 1.0, "you just do what the", r"you just do what the \w+ you want to", "0. You just DO WHAT THE HECK YOU WANT TO."),
    ("unlicense-text", "unlicense", 95, 1.0, "anyone is free to copy modify publish", r"anyone is free to copy modify publish use compile sell or distribute this software", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("unlicense-url", "unlicense", 88, 1.0, "unlicense org", r"unlicense org", "https://unlicense.org"),
    # --- Creative Commons and open data
    ("cc-url-by-sa", "cc-by-sa", 88, 1.0, "creativecommons org licenses by sa", r"creativecommons org licenses by sa", "https://creativecommons.org/licenses/by-sa/"),
    ("cc-url-by-nc-sa", "cc-by-nc-sa", 88, 1.0, "creativecommons org licenses by nc sa", r"creativecommons org licenses by nc sa", "https://creativecommons.org/licenses/by-nc-sa/"),
    ("cc-url-by-nc-nd", "cc-by-nc-nd", 88, 1.0, "creativecommons org licenses by nc nd", r"creativecommons org licenses by nc nd", "https://creativecommons.org/licenses/by-nc-nd/"),
    ("cc-url-by-nc", "cc-by-nc", 88, 1.0, "creativecommons org licenses by nc", r"creativecommons org licenses by nc(?! (?:sa|nd)(?: |$))", "https://creativecommons.org/licenses/by-nc/"),
    ("cc-url-by-nd", "cc-by-nd", 88, 1.0, "creativecommons org licenses by nd", r"creativecommons org licenses by nd", "https://creativecommons.org/licenses/by-nd/"),
    ("cc-url-by", "cc-by", 88, 1.0, "creativecommons org licenses by", r"creativecommons org licenses by(?! (?:sa|nc|nd)(?: |$))", "https://creativecommons.org/licenses/by/"),
    ("cc0-url", "cc0", 88, 1.0, "creativecommons org publicdomain zero", r"creativecommons org publicdomain zero", "https://creativecommons.org/publicdomain/zero/1.0/"),
    ("pdm-url", "public-domain-mark", 88, 1.0, "creativecommons org publicdomain mark", r"creativecommons org publicdomain mark", "https://creativecommons.org/publicdomain/mark/1.0/"),
    ("pdm-name", "public-domain-mark", 55, 1.0, "public domain mark", r"public domain mark(?: 1 0)?", "Public Domain Mark 1.0"),
    ("cc0-text", "cc0", 95, 1.0, "affirmer hereby overtly", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives", "Affirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives"),
    ("cc0-text-waive", "cc0", 95, 1.0, "waived all copyright", r"(?:has|have) waived all copyright and related or neighbou?ring rights", "the author has waived all copyright and related or neighboring rights"),
    ("cc-text-share", "cc-share-adapt", 95, 0.8, "remix transform and build upon", r"remix transform and build upon the material", "You are free to remix, transform, and build upon the material"),
    ("cc-text-redistribute", "cc-share-adapt", 95, 0.8, "redistribute the material in any medium", r"copy and redistribute the material in any medium or format", "copy and redistribute the material in any medium or format"),
    ("cc-text-appropriate", "cc-attribution", 95, 0.8, "give appropriate credit", r"give appropriate credit provide a link to the license", "You must give appropriate credit, provide a link to the license"),
    ("cc-text-nc", "cc-noncommercial", 95, 0.9, "material for commercial purposes", r"may not use the material for commercial purposes", "You may not use the material for commercial purposes."),
    ("cc-text-nd", "cc-noderivatives", 95, 0.9, "may not distribute the modified material", r"you may not distribute the modified material", "you may not distribute the modified material"),
    ("cc-text-sa", "cc-sharealike", 95, 0.9, "under the same license as the original", r"must distribute your contributions under the same license as the original", "you must distribute your contributions under the same license as the original"),
    ("cc-notice-work", "creative-commons", 88, 0.9, "this work is licensed under a creative commons", r"this work is licensed under a creative commons", "This work is licensed under a Creative Commons licence"),
    ("cc-notice-some", "creative-commons", 88, 0.7, "some rights reserved", r"some rights reserved", "Some rights reserved."),
    ("cc-sampling", "cc-sampling", 55, 0.9, "sampling plus", r"creative commons sampling plus", "Creative Commons Sampling Plus"),
    ("odc-by-name", "odc-by", 55, 1.0, "open data commons attribution", r"open data commons attribution licen[cs]e", "Open Data Commons Attribution License"),
    ("pddl-name", "pddl", 55, 1.0, "public domain dedication and licen", r"public domain dedication and licen[cs]e", "Public Domain Dedication and License (PDDL)"),
    ("odbl-short", "odbl", 55, 0.9, "odbl", r"odbl", "ODbL"),
    ("odbl-osm", "odbl", 88, 0.8, "openstreetmap contributors", r"openstreetmap contributors", "© OpenStreetMap contributors"),
    ("cdla-permissive", "cdla-permissive", 55, 1.0, "community data license agreement", r"community data license agreement permissive", "Community Data License Agreement - Permissive"),
    ("cdla-sharing", "cdla-sharing", 55, 1.0, "community data license agreement", r"community data license agreement sharing", "Community Data License Agreement - Sharing"),
    ("ogl-uk", "ogl-uk", 55, 1.0, "open government licen", r"open government licen[cs]e(?: v3 0| v2 0| v1 0)?(?! (?:canada|british))", "Contains public sector information licensed under the Open Government Licence v3.0"),
    ("ogl-canada", "ogl-canada", 72, 1.0, "open government licence canada", r"open government licence canada", "Open Government Licence - Canada"),
    ("etalab-name", "etalab-2.0", 55, 1.0, "etalab", r"licence ouverte(?: open licence)? etalab|etalab licen[cs]e", "Licence Ouverte / Etalab"),
    ("dl-de-name", "dl-de-by-2.0", 55, 1.0, "datenlizenz deutschland", r"datenlizenz deutschland (?:– )?namensnennung", "Datenlizenz Deutschland – Namensnennung – Version 2.0"),
    ("gov-work", "us-government-work", 88, 0.8, "government work", r"(?:united states|u s|us) government work", "This is a United States Government work"),
    ("gov-work-105", "us-government-work", 95, 0.9, "section 105", r"pursuant to (?:title )?17 (?:usc|u s c|united states code) section 105", "pursuant to 17 U.S.C. Section 105"),
    ("gutenberg-text", "project-gutenberg", 95, 0.9, "project gutenberg license", r"under the terms of the project gutenberg license", "re-use it under the terms of the Project Gutenberg License"),
    # --- models, source-available
    ("openrail-name", "openrail", 55, 1.0, "openrail", r"(?:creativeml )?openrail(?: m| s)?", "CreativeML OpenRAIL-M"),
    ("rail-text", "openrail", 95, 0.9, "use based restrictions", r"use based restrictions as referenced in", "the use-based restrictions as referenced in paragraph 5"),
    ("busl-name", "busl-1.1", 72, 1.0, "business source", r"business source licen[cs]e(?: 1 1)?", "Business Source License 1.1"),
    ("busl-text", "busl-1.1", 95, 1.0, "additional use grant", r"additional use grant", "Additional Use Grant: None"),
    ("elastic-name", "elastic-2.0", 72, 1.0, "elastic licen", r"elastic licen[cs]e(?: 2 0)?", "Elastic License 2.0"),
    ("commons-clause", "commons-clause", 95, 1.0, "commons clause", r"commons clause(?: licen[cs]e)? condition", "\"Commons Clause\" License Condition v1.0"),
    ("polyform-name", "polyform", 55, 1.0, "polyform", r"polyform (?:noncommercial|small business|strict|shield|perimeter) licen[cs]e", "PolyForm Noncommercial License 1.0.0"),
    ("fair-source-name", "fair-source", 55, 0.9, "functional source", r"functional source licen[cs]e", "Functional Source License"),
    ("confluent-name", "confluent", 55, 0.9, "confluent community", r"confluent community licen[cs]e", "Confluent Community License"),
    ("prosperity-name", "prosperity", 55, 0.9, "prosperity public", r"prosperity public licen[cs]e", "The Prosperity Public License"),
    ("hippocratic-name", "hippocratic", 55, 0.9, "hippocratic licen", r"hippocratic licen[cs]e", "Hippocratic License"),
    # --- statements without a license's name
    ("domain-author", "public-domain", 45, 0.8, "disclaims copyright to this source code", r"the author disclaims copyright to this source code", "The author disclaims copyright to this source code."),
    ("domain-no-copyright", "public-domain", 45, 0.7, "no known copyright restrictions", r"no known copyright restrictions", "There are no known copyright restrictions on this image."),
    ("domain-no-rights", "public-domain", 45, 0.8, "no rights reserved", r"no rights reserved", "No rights reserved."),
    ("noncommercial-only", "non-commercial", 45, 0.7, "non", r"for non ?commercial (?:use|purposes|research) only", "For non-commercial use only."),
    ("noncommercial-personal", "non-commercial", 45, 0.6, "personal", r"for (?:your )?personal (?:and )?non ?commercial use", "for your personal, non-commercial use"),
    ("academic-only", "research-only", 45, 0.7, "research purposes only", r"for (?:academic |scientific )?research purposes only", "This dataset is for academic research purposes only."),
    ("evaluation-only", "evaluation-only", 45, 0.7, "evaluation", r"for evaluation (?:purposes )?only", "for evaluation purposes only"),
    ("no-commercial-use", "non-commercial", 45, 0.7, "commercial use", r"commercial use is (?:strictly )?(?:prohibited|forbidden|not permitted|not allowed)", "Commercial use is strictly prohibited."),
    ("no-derivatives", "no-derivatives", 45, 0.7, "derivative works", r"(?:may|shall|must) not (?:modify or )?create derivative works", "You may not create derivative works"),
    ("no-training", "no-training", 45, 0.8, "train", r"may not be used to train (?:any )?(?:machine learning|artificial intelligence|ai|language) models?", "This text may not be used to train AI models."),
    ("no-mining", "no-training", 45, 0.7, "text and data mining", r"(?:reserves?|reserved) (?:all )?rights? (?:to|for|of) text and data mining", "The publisher reserves rights for text and data mining"),
    ("no-scraping", "no-training", 45, 0.6, "scrap", r"(?:scraping|web scraping|automated scraping) (?:of this (?:site|website) )?is (?:strictly )?(?:prohibited|forbidden)", "Scraping of this site is strictly prohibited."),
    ("written-permission", "proprietary", 45, 0.6, "written permission", r"without (?:the )?(?:express |prior )?written permission of the (?:publisher|copyright (?:holder|owner)|author)", "without the prior written permission of the publisher"),
    ("written-consent", "proprietary", 45, 0.6, "written consent", r"without (?:our |the )?(?:express |prior )?written consent", "without our prior written consent"),
    ("confidential-trade", "proprietary", 45, 0.7, "trade secret", r"contains (?:confidential|proprietary) (?:information )?and trade secrets?", "This file contains confidential information and trade secrets"),
    ("internal-only", "proprietary", 45, 0.6, "internal use only", r"for internal use only", "For internal use only."),
    ("unauthorised-copying", "proprietary", 45, 0.7, "unauthori", r"unauthori[sz]ed (?:copying|reproduction|duplication) (?:of this file )?(?:via any medium )?is (?:strictly )?prohibited", "Unauthorized copying of this file, via any medium is strictly prohibited"),
    ("eula-agree", "eula", 45, 0.7, "end user licen", r"end user licen[cs]e agreement", "End-User License Agreement"),
    ("eula-bound", "eula", 45, 0.6, "bound by the terms of this", r"agree to be bound by the terms of this (?:licen[cs]e )?agreement", "you agree to be bound by the terms of this agreement"),
    ("eula-reverse", "eula", 45, 0.7, "reverse engineer decompile", r"reverse engineer decompile or disassemble", "You may not reverse engineer, decompile, or disassemble the product"),
    ("shareware", "shareware", 45, 0.7, "shareware", r"(?:is|as) shareware", "This program is shareware."),
    ("freeware", "freeware", 45, 0.7, "freeware", r"(?:is|as) freeware", "This program is freeware."),
    ("reprint", "reprint-permission", 45, 0.6, "reprinted", r"reprinted (?:here )?(?:with|by) (?:kind )?permission", "Reprinted here by kind permission of the estate"),
    ("fair-use", "fair-use", 45, 0.5, "fair use", r"(?:used|reproduced) under fair use", "Image reproduced under fair use."),
    ("crown", "crown-copyright", 45, 0.8, "crown copyright", r"crown copyright", "© Crown copyright 2019"),
    ("getty", "stock-image", 45, 0.6, "getty images", r"(?:courtesy of|photo by|via) getty images", "Photo by Getty Images"),
    # --- notices in other languages
    ("rights-french", "proprietary", 45, 0.6, "tous droits", "tous droits réservés", "Tous droits réservés"),
    ("rights-spanish", "proprietary", 45, 0.6, "todos los derechos", "todos los derechos reservados", "Todos los derechos reservados"),
    ("rights-portuguese", "proprietary", 45, 0.6, "todos os direitos", "todos os direitos reservados", "Todos os direitos reservados"),
    ("rights-german", "proprietary", 45, 0.6, "alle rechte", "alle rechte vorbehalten", "Alle Rechte vorbehalten"),
    ("rights-italian", "proprietary", 45, 0.6, "tutti i diritti", "tutti i diritti (?:sono )?riservati", "Tutti i diritti sono riservati"),
    ("rights-dutch", "proprietary", 45, 0.6, "alle rechten", "alle rechten voorbehouden", "Alle rechten voorbehouden"),
    ("domain-french", "public-domain", 45, 0.7, "domaine public", "dans le domaine public", "dans le domaine public"),
    ("domain-spanish", "public-domain", 45, 0.7, "dominio", "(?:en el|de) dominio público", "una obra de dominio público"),
    ("domain-german", "public-domain", 45, 0.7, "gemeinfrei", "gemeinfrei(?:es werk)?", "Dieses Werk ist gemeinfrei."),
    ("cc-german", "cc-by-sa", 55, 0.9, "namensnennung", "creative commons namensnennung (?:– )?weitergabe unter gleichen bedingungen", "Creative Commons Namensnennung – Weitergabe unter gleichen Bedingungen"),
)
