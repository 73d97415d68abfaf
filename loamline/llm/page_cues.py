"""What a line of a web page says of itself: furniture, teaser, sentence."""

from __future__ import annotations

import re
from functools import lru_cache

# Wording of page furniture, in the languages of the collection. Phrases, not words: an article may well speak
# of cookies, menus, privacy or subscribing.
_NOTICE = re.compile(
    r"\b(?:we|our partners|this (?:web)?site|our (?:web)?site)\b[^.\n]{0,40}\b(?:uses? cookies|process(?:es)? (?:browsing|personal) data|stores? (?:small )?files on your device)|"
    r"^\W*cookies (?:help|allow|let|enable) us\b|\b(?:accept|reject|refuse|allow) all\b|\bmanage (?:choices|cookies|preferences|consent)\b|"
    r"\bcookie (?:policy|notice|settings|preferences)\b|\bnous utilisons des cookies\b|\butilisons? des traceurs\b|\busage de traceurs\b|\butilisation de cookies\b|"
    r"\b(?:este|o nosso) s[ií](?:te|tio)\b[^.\n]{0,30}\bcookies\b|\b(?:utilizamos|usamos) cookies\b|\btovuti hii (?:inatumia|hutumia)\b|\btunatumia vidakuzi\b|\bvidakuzi\b|"
    r"\byou have read \d+ of \d+\b|\bfree articles?\b[^.\n]{0,30}\b(?:left|this month|remaining)\b|\bsubscribe to (?:read|continue|unlock)\b|"
    r"\bvotre navigateur\b|\byour browser (?:is|does|may)\b|\b(?:enable|activate|turn on) java ?script to (?:view|see|read|post|load)\b[^.\n]{0,12}\bcomments?\b|"
    r"\ball rights reserved\.?\s*$|\btous droits réservés\b|\btodos os direitos reservados\b|\bhaki zote zimehifadhiwa\b|^\W*(?:©|\(c\)\s|copyright\b)|"
    r"\bis published (?:in \S+ )?by\b[^.\n]*\b(?:ltd|limited|press|media|group|inc|plc)\b|\b(?:directeur|director|diretor|mhariri)\b[^:\n]{0,30}\s?:\s|"
    r"\bgo back to the (?:front|home) ?page\b|\bback to (?:the )?(?:front|home) ?page\b",
    re.I,
)
_PROMPT = re.compile(
    r"^\W*(?:(?:read|see|watch) (?:also|more|next)\b\s*:?|related\b\s*(?:stories|articles|posts|news)?\s*:?(?=\s|$)|lire aussi\b|à lire\b|voir aussi\b|leia (?:também|mais)\b|veja também\b|soma pia\b|"
    r"tazama pia\b|more (?:from|on|stories)\b|most (?:read|popular|viewed|shared)\W*$|trending(?: now)?\W*$|latest (?:stories|news|posts)\W*$|editor[’']?s? picks?\W*$|"
    r"you may (?:also )?like\W*$|recommended(?: for you)?\W*$|les plus (?:lus|vus|partagés)\W*$|à la une\W*$|sur le même sujet\W*$|derni[eè]res? (?:nouvelles|infos)\W*$|"
    r"mais (?:lidas?|vistas?)\W*$|últimas(?: notícias)?\W*$|zilizosomwa zaidi\W*$|habari (?:mpya|zaidi|kuu)\W*$|advert(?:isement|ising)?\W*$|sponsored\b|publicité\W*$|"
    r"publicidade\W*$|tangazo\W*$|matangazo\W*$|anúncios?\W*$|story continues below|continue reading\b|suite après la publicité|la suite après|"
    r"advertise with us|contact us\W*$|follow us\b|suivez[- ]nous\b|siga[- ]nos\b|tufuate\b|share (?:on|this|via)\b|share\s{1,}(?:tweet|email|print)|partager\b|compartilh|"
    r"shiriki\W*$|copy link|print\W*$|email\W*$|tweet\W*$|\d[\d.,]*\s*(?:shares?|comments?|likes?|views?|partages|commentaires|comentários|maoni)\W*$|"
    r"(?:leave|post|add|write) a (?:comment|reply)|log ?in (?:to|or)\b|sign (?:up|in)\b|subscribe(?: now| to our| today)?\W*$|register(?: now)?\W*$|"
    r"(?:get|receive) [^.\n]{0,40}(?:by sms|by e-?mail|alerts?|newsletter)\b|join our\b|install our\b|download our\b|recevez notre\b|inscrivez-vous\b|abonnez-vous\b|"
    r"receba (?:a|as|o) noss|subscreva\b|jiandikishe\b|pata (?:habari|bei)\b[^.\n]{0,30}sms|"
    r"skip to\b|toggle (?:navigation|menu)|(?:search|rechercher|pesquisar|tafuta)\b[^.\n]{0,18}$|☰|menu\W*$|terms of use\b|terms and conditions\W*$|privacy policy\b|"
    r"mentions légales\b|politique de confidentialité|política de privacidade|termos de uso|sera ya faragha|masharti\W*$|back to top|haut de page|voltar ao topo|rudi juu|"
    r"sitemap\W*$|plan du site\W*$|tel\W{0,2}\s*[\d+]|(?:phone|fax)\W{0,2}\s*[\d+]|photo\s*\d*\W*$|image(?: gallery)?\s*(?:\d+\s*/?\s*\d*)?\W*$|gallery\b|galerie\b|"
    r"video\s*\d*\W*$|reading time\b|temps de lecture\b|tempo de leitura\b|muda wa kusoma\b|text size\b|taille du texte\b|listen to (?:this|the) (?:article|story)\b|"
    r"écouter (?:cet|l')|ouvir (?:este|o) artigo|sikiliza\b[^.\n]{0,20}$|updated?\W*\d|published\W*\d|coming soon\W*$|loading\W*$|noscript\W*$|page \d+ (?:of|/) \d+\W*$|"
    r"tags?\s*:|filed under\b|topics?\s*:|e-?paper\W*$)",
    re.I,
)
# Entries of menus.
_MENU = frozenset(
    "home news menu search about contact us contact-us markets market crops livestock weather prices price jobs regions region opinion podcasts podcast e-paper epaper log in "
    "login log-in sign in register subscribe advertise video videos photos gallery sport sports business politics world local agriculture farming accueil marchés opinion vidéos "
    "météo emploi à propos connexion cultures élevage nous contacter contact annonces início mercados opinião vídeos tempo emprego sobre entrar culturas pecuária contacto "
    "contactos mwanzo maoni video hali ya hewa ajira kuhusu ingia masoko mazao mifugo wasiliana nasi habari policy climate français english kiswahili português".split()
)
_SPLIT = re.compile(r"\s*(?:[|·•»›>/]|\s{2,}|\t)\s*")
_CRUMB = re.compile(r"^\s*[^.!?|>»/›]{1,30}\s+(?:[>»/›])\s+[^.!?>»/›]{1,30}\s+(?:[>»/›])\s+\S")
_AGO = re.compile(r"\(\s*(?:\d+\s*(?:s|sec|min|m|h|hr|hrs|d|days?|hours?|weeks?|j|jours?|heures?|dias?|horas?|siku|saa)\b\s*(?:ago|atrás)?|il y a \d+\s*\w+|há \d+\s*\w+)\s*\)\s*$", re.I)
_NUMBERED = re.compile(r"^\s*\d{1,2}[.)]\s+\S")
_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"[.!?…;:][\"”’'»)\]]*\s*$")
SENTENCE_WORDS = 4


_HINTS = (
    "cookie", "vidakuzi", "traceurs", "browsing data", "personal data", "small files", "files on your", "tovuti hii", "accept all", "reject all", "refuse all", "allow all",
    "manage ", "free article", "you have read", "subscribe to", "navigateur", "your browser", "javascript", "java script", "rights reserved", "droits réservés",
    "direitos reservados", "haki zote", "©", "(c) ", "copyright", "published", "directeur", "director", "diretor", "mhariri", "front page", "home page",
    "frontpage", "homepage",
)  # every alternative of _NOTICE holds one of these


def is_menu(line: str) -> bool:
    """A row of menu entries, or one of them."""
    parts = [p for p in _SPLIT.split(line.strip(" \t\r|·•»›>/☰")) if p]
    if not parts:
        return True
    known = sum(all(w.lower() in _MENU for w in p.split()) for p in parts)
    return known == len(parts) or (len(parts) >= 3 and known >= 0.5 * len(parts) and max(len(p) for p in parts) <= 30)


def ends_sentence(line: str) -> bool:
    return bool(_END.search(line[-8:]))


def _furniture(line: str) -> bool:
    if _PROMPT.match(line):
        return True
    low = line.lower()
    if any(h in low for h in _HINTS) and _NOTICE.search(line):
        return True
    if any(c in line for c in ">»/›") and _CRUMB.match(line):
        return True
    return not (len(line) > 200 or (len(line) > 60 and ends_sentence(line))) and is_menu(line)


_furniture_of_short = lru_cache(maxsize=65_536)(_furniture)  # sites repeat their furniture on every page


def is_furniture(line: str) -> bool:
    """Menus, notices, prompts, bread crumbs: what a site puts around and between its articles."""
    return _furniture_of_short(line) if len(line) <= 90 else _furniture(line)


def is_teaser(line: str) -> bool:
    """A dated or numbered heading of another story."""
    return bool((line.endswith(")") and _AGO.search(line)) or (line[:1].isdigit() and _NUMBERED.match(line) and not ends_sentence(line)))


def is_sentence(line: str) -> bool:
    """Running text: several words and an end of a sentence."""
    return ends_sentence(line) and len(line.split(None, SENTENCE_WORDS)) >= SENTENCE_WORDS


def is_heading_like(line: str) -> bool:
    """Several words without the end of a sentence."""
    return not ends_sentence(line) and len(line.split(None, 5)) >= 5
