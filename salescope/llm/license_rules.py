"""License scan by ordered signature rules.

Each rule is a regular expression over lower-cased text with a label, a priority and
keywords (divided by bars) without any of which it cannot match. One Aho-Corasick pass
finds the keywords in a copy of the text with white space folded to single blanks and
licence spelt license; only their rules run, over the text itself. Detections then suppress each other: one that lies
inside a detection of higher priority, or of equal priority and greater length, goes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.textops import ALNUM_WORD, blocks, slim, word_spans

# Phrases that always count, with their labels (fixed by the query's contract).
BASE = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

V2, V3 = r"(?:,?\s*(?:version|v\.?)?\s*2(?:\.0)?)", r"(?:,?\s*(?:version|v\.?)?\s*3(?:\.0)?)"
OR_LATER = r"(?:\s*,?\s*or\s+(?:\(at your option\)\s+)?(?:any\s+)?later(?:\s+version)?|\+)"
CC = r"(?:creative\s+commons|cc)[\s-]+"

# Label, keyword of the name rule, the name, and (keyword, pattern) of its own web address.
NAMED: tuple[tuple[str, str, str, tuple[str, str] | None], ...] = (
    ("mit", "mit", r"(?:the\s+)?\bmit(?:/x11|/expat)?\s+licen[sc]e", ("opensource.org", r"opensource\.org/licenses?/mit\b")),
    ("mit-0", "mit", r"\bmit\s+no\s+attribution|\bmit-0\b", ("mit-0", r"github\.com/aws/mit-0")),
    ("x11", "x11", r"\bx11\s+licen[sc]e", None),
    ("expat", "expat", r"\bexpat\s+licen[sc]e", ("jclark", r"jclark\.com/xml/copying")),
    ("isc", "isc", r"\bisc\s+licen[sc]e", ("opensource.org", r"opensource\.org/licenses?/isc")),
    ("0bsd", "bsd", r"\b(?:zero[\s-]+clause|0)[\s-]?bsd(?:\s+licen[sc]e)?", None),
    ("bsd-2-clause", "bsd", r"\b(?:simplified|freebsd|(?:2|two)[\s-]+clause)\s+bsd(?:\s+licen[sc]e)?|\bbsd[\s-]2[\s-]clause", ("opensource.org", r"opensource\.org/licenses?/bsd-2-clause")),
    ("bsd-3-clause", "bsd", r"\b(?:new|revised|modified|(?:3|three)[\s-]+clause)\s+bsd(?:\s+licen[sc]e)?|\bbsd[\s-]3[\s-]clause", ("opensource.org", r"opensource\.org/licenses?/bsd-3-clause")),
    ("bsd-4-clause", "bsd", r"\b(?:original|(?:4|four)[\s-]+clause)\s+bsd(?:\s+licen[sc]e)?|\bbsd[\s-]4[\s-]clause", None),
    ("bsd", "bsd", r"\bbsd(?:-style)?\s+licen[sc]e", None),
    ("apache-1.0", "apache", r"\bapache\s+(?:software\s+)?licen[sc]e,?\s*(?:version|v\.?)?\s*1\.0", None),
    ("apache-1.1", "apache", r"\bapache\s+(?:software\s+)?licen[sc]e,?\s*(?:version|v\.?)?\s*1\.1", None),
    ("apache-2.0", "apache", r"\bapache\s+(?:software\s+)?licen[sc]e" + V2 + r"|\bapache[\s-]2(?:\.0)?\b", ("apache.org", r"apache\.org/licenses/license-2\.0")),
    ("gpl-1.0", "general public", r"\bgnu\s+general\s+public\s+licen[sc]e,?\s*(?:version|v\.?)?\s*1(?:\.0)?\b", None),
    ("gpl-2.0", "general public", r"\b(?:gnu\s+)?general\s+public\s+licen[sc]e(?:\s*\(gpl\))?" + V2 + r"\b", ("gnu.org", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0")),
    ("gpl-2.0-or-later", "general public", r"\b(?:gnu\s+)?general\s+public\s+licen[sc]e" + V2 + OR_LATER, None),
    ("gpl-3.0", "general public", r"\b(?:gnu\s+)?general\s+public\s+licen[sc]e(?:\s*\(gpl\))?" + V3 + r"\b", ("gnu.org", r"gnu\.org/licenses/gpl(?:-3\.0)?")),
    ("gpl-3.0-or-later", "general public", r"\b(?:gnu\s+)?general\s+public\s+licen[sc]e" + V3 + OR_LATER, None),
    ("lgpl-2.0", "general public", r"\bgnu\s+library\s+general\s+public\s+licen[sc]e", ("gnu.org", r"gnu\.org/licenses/old-licenses/lgpl-2\.0")),
    ("lgpl-2.1", "general public", r"\blesser\s+general\s+public\s+licen[sc]e,?\s*(?:version|v\.?)?\s*2\.1", ("gnu.org", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1")),
    ("lgpl-3.0", "general public", r"\blesser\s+general\s+public\s+licen[sc]e" + V3 + r"\b", ("gnu.org", r"gnu\.org/licenses/lgpl-3\.0")),
    ("lgpl", "general public", r"\b(?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e", ("gnu.org", r"gnu\.org/licenses/lgpl")),
    ("agpl-1.0", "affero", r"\baffero\s+general\s+public\s+licen[sc]e,?\s*(?:version|v\.?)?\s*1(?:\.0)?\b", None),
    ("agpl-3.0", "affero", r"\b(?:gnu\s+)?affero\s+general\s+public\s+licen[sc]e" + V3 + r"?", ("gnu.org", r"gnu\.org/licenses/agpl")),
    ("gfdl-1.1", "free documentation", r"\bgnu\s+free\s+documentation\s+licen[sc]e,?\s*(?:version|v\.?)?\s*1\.1", None),
    ("gfdl-1.2", "free documentation", r"\bgnu\s+free\s+documentation\s+licen[sc]e,?\s*(?:version|v\.?)?\s*1\.2", None),
    ("gfdl-1.3", "free documentation", r"\bgnu\s+free\s+documentation\s+licen[sc]e,?\s*(?:version|v\.?)?\s*1\.3", ("gnu.org", r"gnu\.org/licenses/fdl-1\.3")),
    ("gfdl", "free documentation", r"\bgnu\s+free\s+documentation\s+licen[sc]e", ("gnu.org", r"gnu\.org/(?:copyleft|licenses)/fdl")),
    ("mpl-1.0", "mozilla public", r"\bmozilla\s+public\s+licen[sc]e,?\s*(?:version|v\.?)?\s*1\.0", None),
    ("mpl-1.1", "mozilla public", r"\bmozilla\s+public\s+licen[sc]e,?\s*(?:version|v\.?)?\s*1\.1", ("mozilla.org", r"mozilla\.org/mpl/1\.1")),
    ("mpl-2.0", "mozilla public", r"\bmozilla\s+public\s+licen[sc]e" + V2 + r"?", ("mozilla.org", r"mozilla\.org/(?:en-us/)?mpl/2\.0")),
    ("epl-1.0", "eclipse public", r"\beclipse\s+public\s+licen[sc]e(?:\s*-)?,?\s*(?:version|v\.?)?\s*1(?:\.0)?\b", ("eclipse.org", r"eclipse\.org/legal/epl-v10")),
    ("epl-2.0", "eclipse public", r"\beclipse\s+public\s+licen[sc]e(?:\s*-)?" + V2 + r"?", ("eclipse.org", r"eclipse\.org/legal/epl-(?:2\.0|v20)")),
    ("edl-1.0", "eclipse distribution", r"\beclipse\s+distribution\s+licen[sc]e", ("eclipse.org", r"eclipse\.org/org/documents/edl")),
    ("cddl-1.0", "common development", r"\bcommon\s+development\s+and\s+distribution\s+licen[sc]e", ("opensource.org", r"opensource\.org/licenses?/cddl")),
    ("cpl-1.0", "common public", r"\bcommon\s+public\s+licen[sc]e", ("opensource.org", r"opensource\.org/licenses?/cpl1\.0")),
    ("cpal-1.0", "common public attribution", r"\bcommon\s+public\s+attribution\s+licen[sc]e", ("opensource.org", r"opensource\.org/licenses?/cpal")),
    ("ipl-1.0", "ibm public", r"\bibm\s+public\s+licen[sc]e", None),
    ("apsl-2.0", "apple public source", r"\bapple\s+public\s+source\s+licen[sc]e", ("opensource.apple", r"opensource\.apple\.com/license/apsl")),
    ("npl-1.1", "netscape public", r"\bnetscape\s+public\s+licen[sc]e", ("mozilla.org", r"mozilla\.org/npl")),
    ("qpl-1.0", "public license", r"\bq\s+public\s+licen[sc]e", None),
    ("sleepycat", "sleepycat", r"\bsleepycat\s+(?:public\s+)?licen[sc]e", None),
    ("artistic-1.0", "artistic", r"\bartistic\s+licen[sc]e,?\s*(?:version|v\.?)?\s*1(?:\.0)?\b|\boriginal\s+artistic\s+licen[sc]e", ("opensource.org", r"opensource\.org/licenses?/artistic-1")),
    ("artistic-2.0", "artistic", r"\bartistic\s+licen[sc]e" + V2 + r"\b", ("opensource.org", r"opensource\.org/licenses?/artistic-2")),
    ("artistic", "artistic", r"\bartistic\s+licen[sc]e", ("perlfoundation", r"perlfoundation\.org/artistic")),
    ("bsl-1.0", "boost", r"\bboost\s+software\s+licen[sc]e", ("boost.org", r"boost\.org/license_1_0")),
    ("busl-1.1", "business source", r"\bbusiness\s+source\s+licen[sc]e", ("mariadb.com", r"mariadb\.com/bsl11")),
    ("sspl-1.0", "server side public", r"\bserver\s+side\s+public\s+licen[sc]e", ("mongodb.com", r"mongodb\.com/licensing/server-side-public")),
    ("elastic-2.0", "elastic", r"\belastic\s+licen[sc]e", ("elastic.co", r"elastic\.co/licensing/elastic-license")),
    ("commons-clause", "commons clause", r"\bcommons\s+clause", ("commonsclause", r"commonsclause\.com")),
    ("unlicense", "unlicense", r"\b(?:the\s+)?unlicense\b", ("unlicense.org", r"unlicense\.org")),
    ("wtfpl", "wtfpl", r"\bwtfpl\b", ("wtfpl.net", r"wtfpl\.net")),
    ("zlib", "zlib", r"\bzlib(?:/libpng)?\s+licen[sc]e", ("zlib.net", r"zlib\.net/zlib_license")),
    ("libpng", "libpng", r"\blibpng\s+licen[sc]e", ("libpng.org", r"libpng\.org/pub/png/src/libpng-license")),
    ("openssl", "openssl", r"\bopenssl\s+licen[sc]e", ("openssl.org", r"openssl\.org/source/license")),
    ("psf-2.0", "python software|psf", r"\bpython\s+software\s+foundation\s+licen[sc]e|\bpsf\s+licen[sc]e", ("python.org", r"python\.org/\S*license")),
    ("cnri-python", "cnri", r"\bcnri\s+(?:open\s+source\s+)?licen[sc]e", None),
    ("php-3.01", "php", r"\bphp\s+licen[sc]e", ("php.net", r"php\.net/license")),
    ("ruby", "ruby", r"\bruby(?:'s)?\s+licen[sc]e", ("ruby-lang", r"ruby-lang\.org/\S*license")),
    ("zpl-2.1", "zope", r"\bzope\s+public\s+licen[sc]e", ("zope.org", r"zope\.org/\S*zpl")),
    ("w3c", "w3c", r"\bw3c\s+(?:software\s+)?(?:notice\s+and\s+)?licen[sc]e", ("w3.org", r"w3\.org/consortium/legal/copyright-software")),
    ("icu", "icu", r"\bicu\s+licen[sc]e", ("unicode.org", r"unicode\.org/copyright")),
    ("ncsa", "ncsa", r"\b(?:university\s+of\s+illinois/)?ncsa\s+open\s+source\s+licen[sc]e", ("opensource.org", r"opensource\.org/licenses?/(?:ncsa|uoi-ncsa)")),
    ("ms-pl", "microsoft|ms-pl", r"\bmicrosoft\s+public\s+licen[sc]e|\bms-pl\b", ("opensource.org", r"opensource\.org/licenses?/ms-pl")),
    ("ms-rl", "microsoft|ms-rl", r"\bmicrosoft\s+reciprocal\s+licen[sc]e|\bms-rl\b", ("opensource.org", r"opensource\.org/licenses?/ms-rl")),
    ("eupl-1.2", "european union|eupl", r"\beuropean\s+union\s+public\s+licen[sc]e|\beupl\b", ("joinup", r"joinup\.ec\.europa\.eu/\S*eupl")),
    ("cecill-2.1", "cecill", r"\bcecill(?:-[abc])?\b", ("cecill.info", r"cecill\.info/licences")),
    ("osl-3.0", "open software", r"\bopen\s+software\s+licen[sc]e", ("opensource.org", r"opensource\.org/licenses?/osl-3")),
    ("afl-3.0", "academic free", r"\bacademic\s+free\s+licen[sc]e", ("opensource.org", r"opensource\.org/licenses?/afl-3")),
    ("ecl-2.0", "educational community", r"\beducational\s+community\s+licen[sc]e", ("opensource.org", r"opensource\.org/licenses?/ecl")),
    ("upl-1.0", "universal permissive", r"\buniversal\s+permissive\s+licen[sc]e", ("oracle.com", r"oss\.oracle\.com/licenses/upl")),
    ("mulanpsl-2.0", "mulan", r"\bmulan\s+psl|\bmulan\s+permissive\s+software\s+licen[sc]e", ("coscl", r"license\.coscl\.org\.cn/mulanpsl")),
    ("ofl-1.1", "open font", r"\b(?:sil\s+)?open\s+font\s+licen[sc]e", ("scripts.sil.org", r"scripts\.sil\.org/ofl")),
    ("lppl-1.3c", "latex", r"\blatex\s+project\s+public\s+licen[sc]e", ("latex-project", r"latex-project\.org/lppl")),
    ("vim", "vim", r"\bvim\s+licen[sc]e", None),
    ("postgresql", "postgresql", r"\bpostgresql\s+licen[sc]e", ("postgresql.org", r"postgresql\.org/about/licen[sc]e")),
    ("ftl", "freetype", r"\bfreetype\s+(?:project\s+)?licen[sc]e", ("freetype.org", r"freetype\.org/license")),
    ("ijg", "jpeg group", r"\bindependent\s+jpeg\s+group", ("ijg.org", r"ijg\.org")),
    ("curl", "curl", r"\bcurl\s+licen[sc]e", ("curl.haxx", r"curl\.haxx\.se/docs/copyright")),
    ("json", "json", r"\bjson\s+licen[sc]e", ("json.org", r"json\.org/license")),
    ("beerware", "beer", r"\bbeer-?ware\b", None),
    ("odbl-1.0", "open database|odbl", r"\bopen\s+database\s+licen[sc]e|\bodbl\b", ("opendatacommons", r"opendatacommons\.org/licenses/odbl")),
    ("odc-by-1.0", "attribution", r"\bopen\s+data\s+commons\s+attribution", ("opendatacommons", r"opendatacommons\.org/licenses/by")),
    ("pddl-1.0", "public domain dedication", r"\bopen\s+data\s+commons\s+public\s+domain\s+dedication", ("opendatacommons", r"opendatacommons\.org/licenses/pddl")),
    ("cdla-permissive-2.0", "community data", r"\bcommunity\s+data\s+licen[sc]e\s+agreement\s*[-–]?\s*permissive", ("cdla.dev", r"cdla\.dev/permissive")),
    ("cdla-sharing-1.0", "community data", r"\bcommunity\s+data\s+licen[sc]e\s+agreement\s*[-–]?\s*sharing", ("cdla.dev", r"cdla\.dev/sharing")),
    ("openrail", "rail", r"\bopenrail(?:-[a-z]+)?\b|\bopen\s+rail\s+licen[sc]e", ("bigscience", r"bigscience\S*rail-license")),
    ("cc0-1.0", "cc0", r"\bcc0(?:\s*1\.0)?\b", ("creativecommons.org", r"creativecommons\.org/publicdomain/zero")),
    ("cc-by-nc-nd", "nc-nd", r"\b" + CC + r"by-nc-nd(?:[\s-]*[1-4]\.0)?", ("creativecommons.org", r"creativecommons\.org/licenses/by-nc-nd")),
    ("cc-by-nc-sa", "nc-sa", r"\b" + CC + r"by-nc-sa(?:[\s-]*[1-4]\.0)?", ("creativecommons.org", r"creativecommons\.org/licenses/by-nc-sa")),
    ("cc-by-nc", "by-nc", r"\b" + CC + r"by-nc(?:[\s-]*[1-4]\.0)?", ("creativecommons.org", r"creativecommons\.org/licenses/by-nc/")),
    ("cc-by-nd", "by-nd", r"\b" + CC + r"by-nd(?:[\s-]*[1-4]\.0)?", ("creativecommons.org", r"creativecommons\.org/licenses/by-nd")),
    ("cc-by-sa", "by-sa", r"\b" + CC + r"by-sa(?:[\s-]*[1-4]\.0)?", ("creativecommons.org", r"creativecommons\.org/licenses/by-sa")),
    ("cc-by", "cc", r"\bcc[\s-]+by(?:[\s-]*[1-4]\.0)?\b(?!-)", ("creativecommons.org", r"creativecommons\.org/licenses/by/")),
    ("cc-by-nc-sa", "noncommercial|non-commercial", r"\bcreative\s+commons\s+attribution-non-?commercial-share-?alike", None),
    ("cc-by-nc-nd", "noncommercial|non-commercial", r"\bcreative\s+commons\s+attribution-non-?commercial-no-?deriv\w*", None),
    ("cc-by-nc", "noncommercial|non-commercial", r"\bcreative\s+commons\s+attribution-non-?commercial", None),
    ("cc-by-sa", "creative commons", r"\bcreative\s+commons\s+attribution[\s-]share-?alike", None),
    ("cc-by", "creative commons", r"\bcreative\s+commons\s+attribution", None),
    ("public-domain", "public domain", r"\b(?:placed\s+in(?:to)?|dedicated\s+to|released\s+in(?:to)?)\s+the\s+public\s+domain", None),
    ("proprietary", "all rights reserved", r"\ball\s+rights\s+reserved\b", None),
    ("proprietary", "proprietary", r"\bproprietary\s+(?:and\s+confidential|licen[sc]e)", None),
)

# Sentences that only the license text itself holds.
SIGNATURES: tuple[tuple[str, str, str], ...] = (
    ("mit", "permission is hereby granted", r"permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person\s+obtaining\s+a\s+copy"),
    ("isc", "purpose with or without fee", r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose\s+with\s+or\s+without\s+fee"),
    ("bsd-2-clause", "redistribution and use", r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms,?\s+with\s+or\s+without\s+modification"),
    ("bsd-3-clause", "endorse or promote", r"neither\s+the\s+names?\s+of[^.]{1,200}endorse\s+or\s+promote\s+products"),
    ("bsd-4-clause", "advertising materials", r"all\s+advertising\s+materials\s+mentioning\s+features"),
    ("apache-2.0", "you may not use this file", r"you\s+may\s+not\s+use\s+this\s+file\s+except\s+in\s+compliance\s+with\s+the\s+licen[sc]e"),
    ("gpl-2.0-or-later", "version 2 of the license", r"either\s+version\s+2\s+of\s+the\s+licen[sc]e,\s+or\s+\(at\s+your\s+option\)\s+any\s+later"),
    ("gpl-3.0-or-later", "version 3 of the license", r"either\s+version\s+3\s+of\s+the\s+licen[sc]e,\s+or\s+\(at\s+your\s+option\)\s+any\s+later"),
    ("lgpl-2.1", "version 2.1 of the license", r"either\s+version\s+2\.1\s+of\s+the\s+licen[sc]e"),
    ("mpl-2.0", "source code form is subject", r"this\s+source\s+code\s+form\s+is\s+subject\s+to\s+the\s+terms\s+of\s+the\s+mozilla\s+public"),
    ("epl-2.0", "accompanying materials", r"this\s+program\s+and\s+the\s+accompanying\s+materials\s+are\s+made\s+available\s+under"),
    ("bsl-1.0", "permission is hereby granted", r"permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person\s+or\s+organization"),
    ("zlib", "provided 'as-is'", r"this\s+software\s+is\s+provided\s+'as-is',\s+without\s+any\s+express\s+or\s+implied\s+warranty"),
    ("unlicense", "free and unencumbered", r"this\s+is\s+free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain"),
    ("wtfpl", "do what the", r"do\s+what\s+the\s+fuck\s+you\s+want\s+to"),
    ("ofl-1.1", "font software is licensed", r"this\s+font\s+software\s+is\s+licensed\s+under\s+the\s+sil"),
    ("postgresql", "without a written agreement", r"without\s+fee,\s+and\s+without\s+a\s+written\s+agreement\s+is\s+hereby\s+granted"),
    ("beerware", "buy me a beer", r"you\s+can\s+buy\s+me\s+a\s+beer\s+in\s+return"),
    ("proprietary", "strictly prohibited", r"unauthori[sz]ed\s+copying\s+of\s+this\s+file[^.]{0,80}strictly\s+prohibited"),
    ("cc0-1.0", "copyright and related", r"waived\s+all\s+copyright\s+and\s+related\s+or\s+neighboring\s+rights"),
)
FAMILIES: tuple[tuple[str, str, str], ...] = (
    ("gpl", "gpl", r"\bgpl(?:\s*v?\d(?:\.\d)?)?\+?"),
    ("lgpl", "lgpl", r"\blgpl(?:\s*v?\d(?:\.\d)?)?\+?"),
    ("agpl", "agpl", r"\bagpl(?:\s*v?\d(?:\.\d)?)?\+?"),
    ("gpl", "general public", r"\bgeneral\s+public\s+licen[sc]e"),
    ("apache", "apache", r"\bapache\s+(?:software\s+)?licen[sc]e"),
    ("creative-commons", "creative commons", r"\bcreative\s+commons\b"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: re.Pattern
    priority: int


SPACES = re.compile(r"\s+")
SIGNATURE, TAG, ADDRESS, GRANT, NAME, FAMILY = 100, 95, 90, 85, 70, 40
GRANTS = r"(?:licen[sc]ed|released|distributed|available|published|provided|covered)\s+(?:to\s+\w+\s+)?under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?"


def rules() -> list[Rule]:
    """Every rule: signatures, tags, addresses, grants, names and families."""
    found = [Rule(label, key, re.compile(p), SIGNATURE) for label, key, p in SIGNATURES]
    for label in dict.fromkeys(label for label, *_ in NAMED):
        tag = r"spdx-license-identifier:\s*" + re.escape(label) + r"(?:-only)?(?![\w.+-])"
        found.append(Rule(label, "spdx-license-identifier", re.compile(tag), TAG))
    for label, key, name, address in NAMED:
        if address:
            found.append(Rule(label, address[0], re.compile(r"(?:https?://)?(?:www\.)?" + address[1]), ADDRESS))
        found.append(Rule(label, key, re.compile(GRANTS + f"(?:{name})"), GRANT))
        found.append(Rule(label, key, re.compile(name), NAME))
    found += [Rule(label, key, re.compile(p), FAMILY) for label, key, p in FAMILIES]
    return found


class Scanner:
    def __init__(self):
        import ahocorasick

        self.by_keyword: dict[str, list[Rule]] = {}
        for rule in rules():
            for keyword in rule.keyword.split("|"):
                self.by_keyword.setdefault(keyword, []).append(rule)
        self.automaton = ahocorasick.Automaton()
        for keyword in self.by_keyword:
            self.automaton.add_word(keyword, keyword)
        self.automaton.make_automaton()

    def detections(self, lower: str) -> list[tuple[int, int, Rule]]:
        """Kept detections (start, end, rule) in the order of the text."""
        folded = SPACES.sub(" ", lower).replace("licence", "license")
        near = [r for k in sorted({k for _, k in self.automaton.iter(folded)}) for r in self.by_keyword[k]]
        found = [(m.start(), m.end(), rule) for rule in dict.fromkeys(near) for m in rule.pattern.finditer(lower)]
        return suppressed(found)


def suppressed(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Without detections inside another of higher, or equal, priority.

    In the order (start, longest, highest, label) every container comes first, so the
    furthest end so far at each priority decides. Of equal detections the first stays.
    """
    kept, reach = [], {}
    for start, end, rule in sorted(found, key=lambda d: (d[0], -d[1], -d[2].priority, d[2].label)):
        if not any(p >= rule.priority and e >= end for p, e in reach.items()):
            kept.append((start, end, rule))
        reach[rule.priority] = max(reach.get(rule.priority, 0), end)
    return kept


def base_places(lower: str) -> tuple[list[int], set[str]]:
    """Word positions where a base phrase starts (one per phrase), and the labels."""
    if "license" not in lower:
        return [], set()
    words = WORD.findall(lower)
    places, labels = [], set()
    for phrase, label in BASE.items():
        n, last = len(phrase), phrase[-1]
        at = n - 1
        while True:
            try:
                at = words.index(last, at)
            except ValueError:
                break
            if tuple(words[at - n + 1 : at + 1]) == phrase:
                places.append(at - n + 1)
                labels.add(label)
            at += 1
    return places, labels


BASE_SCORE = 0.6
FIELDS = (
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("detections", pa.string()),
)
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, detections string"
)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document; ``detections`` lists ``label:start:end`` in code points.

    ``score`` is the priority of the best detection over 100, at least 0.6 with a base
    phrase, 0 without any. Null and empty texts have no words and score 0. Map-only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch, data, offsets in blocks(batches):
            n_words = np.diff(word_spans(data, offsets, ALNUM_WORD)[2])
            raw = data.tobytes().lower()
            rows = []
            for a, b, n in zip(offsets, offsets[1:], n_words):
                lower = raw[a:b].decode()
                kept = scanner.detections(lower)
                places, labels = base_places(lower)
                score = max([d[2].priority / 100 for d in kept] + [BASE_SCORE] * bool(places), default=0.0)
                every = labels | {d[2].label for d in kept}
                spans = ",".join(f"{d[2].label}:{d[0]}:{d[1]}" for d in kept)
                first, last = (min(places), max(places)) if places else (None, None)
                rows.append((int(n), len(places), first, last, ",".join(sorted(labels)), ",".join(sorted(every)), score, spans))
            arrays = [pa.array(c, t) for c, (_, t) in zip(zip(*rows), FIELDS[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], [n for n, _ in FIELDS])

    rows = slim(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, SCHEMA)
