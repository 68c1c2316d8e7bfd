"""Language of a text as a column: scripts first, then telling letters, then marker counts; JVM expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scripts in the order in which they decide.
SCRIPTS = [
    ("ukrainian", "[іїєґІЇЄҐ]"),
    ("russian", "[\u0400-\u04ff]"),
    ("hindi", "[\u0900-\u097f]"),
    ("arabic", "[\u0600-\u06ff]"),
    ("hebrew", "[\u0590-\u05ff]"),
    ("korean", "[\uac00-\ud7af]"),
    ("japanese", "[\u3040-\u30ff]"),
    ("chinese", "[\u4e00-\u9fff]"),
    ("thai", "[\u0e00-\u0e7f]"),
    ("greek", "[\u0370-\u03ff]"),
]

# Markers of each language and how many must be there, in the order that breaks ties.
MARKERS = [
    ("slovak", 1, r"""\b(som|sme|sú|nie\s+je|môj|moja|moje|môjho|môjmu|vďaka|ďakujem|ďakuje|prepáčte|vo\b|súd|súdu|súdom|sudkyňa|sudca|sudkyne|
rozsudok|rozsudku|rozsudkom|žalobca|žalobcu|žalobcovi|žalobcom|žalovaný|žalovaného|žalovanému|žalovaným|
vyhlásil|vyhlásila|vyhlásilo|vyhlásili|vyhlásiť|rozhodol|rozhodla|rozhodlo|rozhodli|rozhodnúť|prospech|prospechu|prospechom|
rodné\s+číslo|narodená|narodený|narodenej|mestsk[ýéáeéouá]\w*|krajsk[ýéáou]\w*|okresn[ýéáou]\w*|slovensk[ýáéouá]\w*|
prejednáv\w+|konanie|konania|návrh|otcovi|matke|povedať|robiť|nájsť|hovorím|môže[mš]?\b|musím\b|chcem\b|ktor[áéýou][a-ž]*|pretože\b|
tiež\b|aj\b|takže\b|lebo\b|naopak\b|vlastne\b|dokonca\b|hneď\b|teraz\b|včera\b|zajtra\b|dnešok|včerajš\w+|
pre\b|cez\b|ako\b|aby\b|\w+ovať\b)"""),
    ("hungarian", 2, r"""\b(egy|nincs|vannak|hogy|igen|után|által|miatt|benyújt\w+|bíróság\w*|kereset\w*|ítélet\w*|törvény\w*|jogi|jogász\w*|
ők|én|született|szerzett|szerez\w+|diplomá\w+|magyar\w*|Magyar\w+|Budapest\w*|gimnázium\w*|egyetem\w*|szolgálat\w*|elnök\w*|kormány\w*|
alapít\w+|\w{4,}nak\b|\w{4,}nek\b|\w{4,}ban\b|\w{4,}ben\b|\w{4,}ról\b|\w{4,}ből\b|\w{4,}vel\b|\w{5,}or(?:szág)?on\b|\w{4,}váron\b|
\w{4,}városban\b|\w{5,}ön\b|\w{4,}úton\b|\w{4,}dobozon\b|\w{4,}t[óő]l\b|\w{4,}h[eo]z\b|\w{4,}höz\b|\w{4,}[uü]l\b|\w{4,}ig\b)"""),
    ("finnish", 2, r"""\b(että|joka|jonka|jolla|ovat|olen|olet|olemme|olette|on|ei|käräjäoikeu\w+|kanne\w+|jätt\w+|nost\w+|
Helsing\w+|Suomi|suomalainen)\b|\w{3,}(ssa|ssä|sta|stä|lla|llä|iin|sta|tä|llä)\b"""),
    ("estonian", 2, r"""\b(on|olen|oled|oleme|olete|ei|ja|see|kui|esita\w+|hagi\w+|kohtu\w+|esitas|esitada|esitan|
Tallinn\w*|Tartu\w*|Eesti\w*)\b"""),
    ("lithuanian", 2, r"""\b(yra|esu|esi|esame|esate|taip|kad|kuris|kuri|pateik\w+|ieškin\w+|apylinkės|apylinkę|teism\w+|Vilni\w*|Kauno|lietuv\w+)\b"""),
    ("latvian", 2, r"""\b(ir|esmu|esi|esam|esat|nav|tas|kas|šis|tā|iesniedz\w+|prasīb\w+|ties\w+|\w+iem\b|\w+ām\b|\w+ību\b)"""),
    ("polish", 2, r"""\b(oraz|jest|który|która|które|przez|nie|tak|sądu|sądem|sądowi|sąd\w*|pozew|wniósł|sprawa|sygnatur\w+|się|już|albo|jeśli|wszystk\w+)"""),
    ("romanian", 3, r"""\b(este|sunt|sînt|să|și|sau|depus|plângere|tribunal\w*|judecător\w*|reclamant\w*|pârât\w*|prin|pentru|
\w{4,}ului\b|\w{4,}ele\b|\w{4,}lor\b)"""),
    ("slovenian", 2, r"""\b(jaz|moj|moja|moje|tukaj|kakor|kar|vlož\w+|tožb\w+|sodišč\w+|Ljubljan\w*|Mariborsk\w*|slovensk\w*)\b"""),
    ("croatian", 2, r"""\b(jesam|jesi|jesmo|jeste|nije|nećemo|podni\w+|tužb\w+|što|kojeg|kojem|zatim|već\b|ipak|Zagreb\w*|Hrvatsk\w*|hrvatsk\w*)\b"""),
    ("serbian", 2, r"""\b(jesam|jesi|jesmo|jeste|nije|nećemo|podne\w+|tužb\w+|šta|kojeg|kojem|već\b|ipak|Beograd\w*|Srbij\w*|srpsk\w*)\b"""),
    ("dutch", 3, r"""\b(het|een|maar|niet|zijn|waren|wij|hij|zij|heeft|hebben|aangespan\w+|rechtbank\w*|zaak|tegen|tussen|onder|
\w{3,}ij\w*|\w{3,}lijk\b|\w{3,}heid\b)"""),
    ("german", 2, r"""\b(der|die|das|den|dem|des|ein|eine|einen|einem|einer|und|oder|ist|sind|war|waren|hat|haben|wird|werden|von|für|mit|nicht|
sich|nach|zu|Klage|eingereicht|Landgericht|Vertrag)"""),
    ("portuguese", 3, r"""\b(os|as|um|uma|dos|das|no|na|nos|nas|mas|não|são|foi|foram|tem|tinha|tiveram|ação|acção|tribunal|entrou|entrar|com)\b"""),
    ("spanish", 3, r"""\b(el|la|los|las|un|una|del|pero|son|fue|fueron|está|están|demanda|tribunal|presentó|presentaron|ante|por|para)\b"""),
    ("italian", 3, r"""\b(il|la|gli|le|un|una|di|del|della|degli|delle|nel|nella|ma|non|è|sono|era|erano|hanno|stato|sono|causa|tribunale|
presentato|presentata)\b"""),
    ("french", 2, r"""\b(les|du|des|aux|une|mais|ne|pas|est|sont|déposé|déposée|plainte|tribunal|cour)\b"""),
    ("danish", 2, r"""\b(at|den|det|en|er|har|ikke|jeg|du|indgav|sag|byret|tingret)"""),
    ("swedish", 2, r"""\b(att|det|en|är|har|inte|jag|du|på|lämnade|stämning|tingsrät\w+|domstol\w*)"""),
    ("norwegian", 2, r"""\b(at|det|en|er|har|ikke|jeg|du|på|levert|søksmål|tingret\w+)"""),
    ("english", 2, r"""\b(the|and|of|in|on|at|with|from|since|by|for|to|filed|lawsuit|court|claim|notice|plaintiff|defendant|ruled|
are|is|was|were|been|being|have|has|had|having|will|would|could|should|may|might|can|cannot|must|don't|doesn't|isn't|aren't|wasn't|weren't|
haven't|hasn't|hadn't|this|that|these|those|it|its|we|us|they|them|their|writing|writes|wrote|written|building|builds|built|made|making|
develop|developed|developing|requires|required|require|using|use|used|software|hardware|computer|technology|system|
manufacturing|production|service|services|careful|planning|important|please|thank|sorry|hello|hi|about|tomorrow|today|yesterday|
here|there|where|when|how|why|something|anything|nothing|everything|people|person|company|business|\w+ing\b)"""),
]

# Letters that count three times, and telling letters and words.
LETTERS = {"german": "[ß]", "french": "[çêëîïâôûœÇÊËÎÏÂÔÛŒ]", "spanish": "[ñ¿¡Ñ]", "portuguese": "[ãõÃÕ]", "polish": "[ąęłżźćńŁ]", "hungarian": "[őűŐŰ]"}
CZECH_LETTERS = "[řěůŘĚŮ]"
CZECH_TAGS = r"""\b(IČO|DIČ|RČ|SPZ|OP|datovka|datová\s+schránka|PSČ|sp\.\s?zn\.|č\.j\.|čj\.|Ing\.|Bc\.|Mgr\.|MUDr\.|JUDr\.|MVDr\.|PhDr\.|RNDr\.|
Ph\.?D\.?|a\.s\.|s\.r\.o\.|spol\.\s+s\s+r\.o\.|v\.o\.s\.|Kč|korun\s+čes\w+|krajský\s+soud|okresní\s+soud|městský\s+soud|nejvyšší\s+soud|
ústavní\s+soud|vrchní\s+soud)"""
SLOVAK_LETTERS = "[ľĺŕĽĹŔ]"
SLOVAK_WORDS = r"""\b(poisť\w+|sociáln[yeo][acgmh]?\w*|výživn(?:ého|om|ého)?|ponechať|ponechan\w+|nesúhlas\w+|žiadosť|žiadam|žiada\w+|nakoľko|
vyživovac\w+|nevyplat\w+|nepodieľ\w+|vyjadr\w+\s+k(?:u|\s)|povinnosti|povinnosť|oprávnen[yé]|prehľad|prehlad|dlh\b|dlhu\b|dlžné|
Slovensk\w+|slovensk\w+|Bratislav\w+(?:\s+II)?|Mestský\s+súd|poškoden\w+|konaní|konanie|konania|\w{3,}aj[úu]\b|\w{3,}uj[úu]\b|
\w{3,}ovan[áéý]\s+(?:[a-žá-ž]+om|[a-žá-ž]+ov)\b|neurológ\w*|sledovan[áéýou]\s+\w+om|
\w{4,}om\b\s+(?:bol|bola|bolo|boli|som|si|sme|sú|je|nie)|vďak\w*|ďakuj\w+|
\b(máj|jún|júl|august|január|február|marec|apríl|október|december|november)\s+\d{4}|prichádz\w+|odchádz\w+|transakci[aei]|narodená\b|narodený\b)"""
VIETNAMESE, ESTONIAN, ROMANIAN, SCANDINAVIAN = "[ươĐƠƯ]|ễ|ử|ự|ợ|ờ|ằ|ặ|ề|đ", "õ", "[ăâțșȘȚ]", "[æøåÆØÅ]"
TURKISH = r"[ışğ]|\bİ"
TWO_LATIN = "[A-Za-zÀ-ÿĀ-žȀ-ɏ]{2,}"
SCANDINAVIANS = ("danish", "swedish", "norwegian")


def _pattern(p: str, words: bool = True) -> str:
    p = p.replace("\n", "")
    return "(?iU)" + p if words else "(?U)" + p


def count(text: Column, pattern: str, words: bool = True) -> Column:
    return F.regexp_count(text, F.lit(_pattern(pattern, words)))


def language_scores(text: Column) -> dict[str, Column]:
    """Score of each Latin-script language, null where it is not admitted; Czech last."""
    out = {}
    for name, least, pattern in MARKERS:
        found = count(text, pattern)
        boost = count(text, LETTERS[name], False) * 3 if name in LETTERS else F.lit(0)
        out[name] = F.when((found >= least) | (boost >= 6), found + boost)
    letters, tags = count(text, CZECH_LETTERS, False), count(text, CZECH_TAGS)
    out["czech"] = F.when((letters >= 1) | (tags >= 1), F.greatest(letters * 3, tags * 5))
    return out


def _best(scores: dict[str, Column]) -> Column:
    """Name of the greatest score, the first of equals; null if all are null."""
    top = F.greatest(*scores.values())
    return reduce(lambda c, kv: c.when(kv[1] == top, kv[0]), [*scores.items()], F.when(F.lit(False), ""))


def _by_counts(text: Column) -> Column:
    """Language of a text in Latin script. All counts are taken once, into a struct that one lambda then reads."""
    taken = {f"s_{n}": c for n, c in language_scores(text).items()} | {f"n_{n}": count(text, p) for n, _, p in MARKERS if n in SCANDINAVIANS}
    taken |= {"letters": count(text, SLOVAK_LETTERS, False), "words": count(text, SLOVAK_WORDS), "czech": count(text, CZECH_LETTERS, False)}
    taken |= {"vi": count(text, VIETNAMESE, False), "et": count(text, ESTONIAN, False), "ro": count(text, ROMANIAN, False), "north": count(text, SCANDINAVIAN, False)}
    taken |= {"tr": count(text, TURKISH, False), "latin": count(text, TWO_LATIN, False)}

    def decide(s: Column) -> Column:
        letters, words = s["letters"], s["words"]
        strong = (letters >= 3) | ((letters >= 1) & (words >= 3)) | ((letters == 0) & (words >= 4))
        return (
            F.when(strong & (s["czech"] <= F.greatest(letters, words) * 2), "slovak")
            .when(s["vi"] >= 2, "vietnamese")
            .when(s["et"] > 0, "estonian")
            .when(s["ro"] >= 2, "romanian")
            .when(s["north"] > 0, _best({n: s[f"n_{n}"] for n in SCANDINAVIANS}))
            .when(s["tr"] > 0, "turkish")
            .otherwise(F.coalesce(_best({n: s[f"s_{n}"] for n in [*(m[0] for m in MARKERS), "czech"]}), F.when(s["latin"] > 0, "czech").otherwise("unknown")))
        )

    return F.get(F.transform(F.array(F.struct(*[c.alias(n) for n, c in taken.items()])), decide), F.lit(0))


def detect_language(text: Column) -> Column:
    """Language of a text; `unknown` without two Latin letters in a row, null for null."""
    out = F.when(text.isNull(), F.lit(None).cast("string"))
    for name, chars in SCRIPTS:
        out = out.when(F.regexp_like(text, F.lit(chars)), name)
    return out.otherwise(_by_counts(text))
