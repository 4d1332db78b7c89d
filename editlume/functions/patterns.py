"""Quality-template patterns by wiki, in a dialect that Java and RE2 both accept.

`None`: the wiki is supported but has no such template, the flag is 0.
"""

from __future__ import annotations

# The template names each wiki uses to mark an article's status.
FEATURED_ARTICLE: dict[str, str | None] = {
    "dewiki": r"\{\{[Ee]xzellent\|.*\|[0-9]*\}\}",
    "enwiki": r"\{\{[Ff]eatured [Aa]rticle\}\}",
    "eswiki": r"\{\{[Aa]rt.*culo [Dd]estacado\}\}",
    "frwiki": r"\{\{Article de qualit.*\|.*\}\}",
    "itwiki": r"\{\{[Vv]etrina\|.*\}\}",
    "jawiki": r"\{\{[Ff]eatured.*[Aa]rticle\}\}",
    "nlwiki": r"\{\{[Ee]talage\}\}",
    "plwiki": r"\{\{[Mm]edal\}\}",
    "ptwiki": r"\{\{[Aa]rtigo [Dd]estacado\}\}",
    "ruwiki": r"\{\{Избранная статья\|.*\}\}",
    "zhwiki": r"\{\{[Ff]eatured.*[Aa]rticle\}\}",
    "svwiki": r"\{\{[Uu]tm.*rkt\}\}",
    "trwiki": r"\{\{[Ss]eçkin [Mm]adde\}\}",
    "fiwiki": r"\{\{[Ss]uositeltu\}\}",
    "cswiki": r"\{\{[Nn]ejlepší článek\}\}",
    "idwiki": r"\{\{[Ff]eatured.*[Aa]rticle\}\}",
    "thwiki": r"\{\{บทความคัดสรร\}\}",
    "arwiki": r"\{\{مقالة مختارة\}\}",
    "kowiki": r"\{\{알찬 글 딱지\}\}",
    "hewiki": r"\{\{ערך מומלץ\}\}",
    "nowiki": r"\{\{[Uu]tmerket\}\}",
    "huwiki": r"\{\{[Kk]iemelt.*\}\}",
    "viwiki": r"\{\{[Ss]ao chọn lọc.*\}\}",
    "ukwiki": r"\{\{медаль.*\}\}",
    "dawiki": r"\{\{[Ff]remragende.*\}\}",
    "fawiki": r"\{\{مقاله برگزیده\}\}|\{\{نوشتار برگزیده\}\}",
    "rowiki": r"\{\{[Aa]rticol de [Cc]alitate\}\}",
    "cawiki": r"\{\{[Aa]rticle de [Qq]ualitat\}\}|\{\{1000\+AdQ.*\}\}",
    "bgwiki": r"\{\{Избрана статия.*\}\}",
    "hrwiki": r"\{\{[Ii]zdvojeni članak.*\}\}",
    "elwiki": r"\{\{[Αα]ξιόλογο άρθρο\}\}",
    "skwiki": r"\{\{[Pp]erfektný článok\}\}",
    "srwiki": r"\{\{изабрани\}\}",
    "ltwiki": r"\{\{SavStr\}\}",
    "slwiki": r"\{\{zvezdica\}\}",
    "etwiki": r"\{\{eeskujulikud artiklid\}\}",
    "mswiki": r"\{\{rencana pilihan\}\}",
    "euwiki": r"\{\{[Nn]abarmendutako artikulua\}\}",
    "glwiki": r"\{\{[Aa]rtigo de calidade\}\}",
    "simplewiki": r"\{\{[Ff]eatured [Aa]rticle\}\}",
    "iswiki": r"\{\{Úrvalsgrein\}\}",
    "fowiki": r"\{\{Mánaðargrein\}\}",
    "scowiki": None,
    "furwiki": None,
}
FEATURED_LIST: dict[str, str] = {
    "dewiki": r"\{\{[Ii]nformativ\}\}",
    "enwiki": r"\{\{[Ff]eatured [Ll]ist\}\}",
}
GOOD_ARTICLE: dict[str, str] = {
    "dewiki": r"\{\{[Ll]esenswert\|.*\|[0-9]*\}\}",
    "enwiki": r"\{\{[Gg]ood [Aa]rticle\}\}",
    "eswiki": r"\{\{[Aa]rt.*culo [Bb]ueno\}\}",
    "frwiki": r"\{\{[Bb]on [Aa]rticle\|.*\}\}",
    "itwiki": r"\{\{Voce di qualità\|.*\}\}",
    "jawiki": r"\{\{[Gg]ood [Aa]rticle\}\}",
    "plwiki": r"\{\{[Dd]obry [Aa]rtykuł\}\}",
    "ptwiki": r"\{\{[Aa]rtigo [Bb]om\}\}",
    "ruwiki": r"\{\{Хорошая статья\|.*\}\}",
    "dawiki": r"\{\{[Gg]od\}\}",
    "iswiki": r"\{\{Gæðagrein\}\}",
}


def check_wiki(wiki: str) -> None:
    """Unsupported wikis fail when the plan is built, before any data is read."""
    if wiki not in FEATURED_ARTICLE:
        raise RuntimeError(f"unsupported wiki: {wiki}")
