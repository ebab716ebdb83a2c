"""Texts written for the tests, some of every form; the test model is fitted on them."""

WRITTEN: list[tuple[str, str]] = [
    ("prose", "Den gamla vakten följde en smal stig över berget och hittade en glömd dörr. Ingen har sett vakten igen."),
    ("prose", "Chansen att hitta gården är 40 procent."),
    ("prose", "Slå 2T6+1 och jämför med tabellen: vid 9 eller mer vaknar draken, annars går fyra mynt förlorade."),
    ("prose", "\"Vi måste rädda byn\", viskade Lunor."),
    ("prose", "I Narvik säljs hjälmar, tre lyktor, en bok och två rostiga svärd."),
    ("prose", "Vägen mellan Osby och Tormark går genom djup skog,\ndär en mörk ryttare ofta söker de resande. När natten\nfaller hörs klockor från tornet."),
    ("prose", "Reglerna för klättring gäller också då väggen\när våt. Misslyckas slaget förlorar rollper-\nsonen 1T6 poäng."),
    ("prose", "12\nSpelledaren slår 1T8 och jämför med tabellen för vargar."),
    ("prose", "SKUGGORNAS BOK\nEn kväll i regnet kom tre tjuvar till kapellet för att stjäla skatten."),
    ("prose", "Vinor, Griak och Peldan delar på 41 guldmynt, 20 silvermynt och en karta."),
    ("prose", "Priset är 8 silvermynt för en yxa."),
    ("prose", "Om rollpersonerna öppnar kistan kan de hitta ett brev. Det sägs att brevet talar om en hemlig port under sjön. Den som läser brevet måste glömma vägen hem innan solen går upp."),
    ("list", "- yxa\n- gammal hjälm\n- tre facklor\n- karta"),
    ("list", "• svärd (1T8)\n• sköld\n• mantel, 2 st\n• bok"),
    ("list", "1. dörr\n2. mörk källare\n3. brunn\n4. trappa, 12 st"),
    ("list", "a) häst\nb) sliten sadel\nc) rep\nd) lykta"),
    ("list", "yxa, gammal hjälm, tre facklor, karta (1T4), rep, lykta, sliten sadel, brev"),
    ("list", "kista; djup brunn; trappa, 12 st; mörk källare; port; torn; klippa"),
    ("list", "– varg\n* björn\n– vild häst\n* orm (2T6)"),
    ("list", "Gammal präst\nHäxa\nTvå tjuvar\nSmed (1T6)\nFattig köpman"),
    ("list", "1) kapell\n2) helig ruin, 4 st\n3) altare\n4) grav"),
    ("list", "rimlykta; benbok; askring (3T8); liten gasthjälm, 9 st; skogsbro"),
    ("list", "* järnsköld\n* rostig järnhjälm\n* nyckel, 7 st"),
    ("list", "Askmynt\nVit runsten, 3 st\nFuktig nattkarta\nOrm"),
    ("table", "Yxa\t1T8\t12\nSvärd\t1T8+1\t20\nDolk\t1T4\t4"),
    ("table", "Yxa        1T8    12\nSvärd    1T8+1    20\nDolk       1T4     4"),
    ("table", "| Yxa | 1T8 | 12 |\n| Svärd | 1T8+1 | 20 |\n| Dolk | 1T4 | – |"),
    ("table", "Yxa;1T8;12\nSvärd;1T8+1;20\nDolk;1T4;–"),
    ("table", "Kapitel ett .......... 12\nDörren .............. 18\nBrunnen ........ 40"),
    ("table", "01–10   Varg   1T6\n11–20   Björn   2T6\n21–30   Gammal häxa   –"),
    ("table", "Häst\t40%\nMula\t35%\nÅsna\t–\nKamel\t11"),
    ("table", "Rostig hjälm           4    12%\nRingväv               3T6    –\nStor sköld             –    90"),
    ("table", "Björnskinn;3;–;44%\nTunn väst;1;2T4;–"),
    ("table", "| Stig | 14% |\n| Bro | 2T8 |\n| Mörk skog | – |"),
    ("table", "Silverkanna ................ 3T10\nTennfat ...... –\nBägare ............... 77%"),
    ("table", "1–2   Regn   11\n3–4   Dimma   –\n5–6   Sol   4T4"),
    ("junk", "xkr vbn tplq mmr zxc vvt krp lnd brq"),
    ("junk", "#¤%& /()= ;:_* ^~' {[]} \\|<> §½ ~~ ^^ ¤¤"),
    ("junk", "■□▪ ▯■■ □▪¿ ?^`■ ▪▪□ ^^¿ ■"),
    ("junk", "4421 88 301 7723 1 90 5512 66 7 8123 44- 09. 551"),
    ("junk", "lykta lykta lykta lykta lykta lykta lykta lykta lykta lykta"),
    ("junk", "r t ä m , | s o d b a n u k l . f d ö p"),
    ("junk", "qrst bcdfg hjkl mnp vwxz krstv bbn"),
    ("junk", "ï¿½ ï¿½ Ã¤Ã¥ ï¿½ ï¿½Ã¶ Â½ ï¿½ï¿½ Ã"),
    ("junk", "_.-~ '' ,, .. -- ~~ ;; :: __ // \\\\ ** ++"),
    ("junk", "00 00 00 11 0 1 00110 10 01 0 0 1 000"),
    ("junk", ". , | ö d | . ä t k g | m , f å"),
    ("junk", "bok bok bok bok bok bok bok bok bok bok bok bok"),
]
