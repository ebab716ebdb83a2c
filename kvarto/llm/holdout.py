"""Texts of the corpus whose form was judged by reading them; they calibrate the classifier and are never used to choose its splits.

They were drawn from the test table by a hash of `row_id`, some of every form, and are quoted whole.
"""

HOLDOUT: list[tuple[str, str]] = [
    ("junk", "Chansen ï¿½att ï¿½tala ï¿½om ï¿½det ï¿½halvruttna ï¿½krÃ¥klÃ¤gret ï¿½Ã¤r ï¿½78 ï¿½procent. ï¿½Draisk ï¿½frÃ¥n ï¿½Grivinvik ï¿½begravde ï¿½sju ï¿½benormar, ï¿½och ï¿½ingen ï¿½har ï¿½motvilligt ï¿½sett ï¿½den ï¿½tysta ï¿½benritualen ï¿½igen."),
    ("junk", "III 1111 ............. iiiiiii ......... llllllllllllllllllllll 11111111111111111111 IIIIIIIIIIIIIIIIIIII llll |||| lllllllllllllllll iiiiiii |||||||||| ||||||||||||||| llllllllllllllllllll"),
    ("junk", "□ ¿■^□¿¿ ??□ ■?`■`▯▪?`▯ ?▯¿■▪^¿ □¿¿`^¿□■■■▯□■¿^□ `□`■^?■□▯■?▪¿□□`□ □▯` ?▪▯□■■^▯`□?¿¿¿¿^ ■■■^`?□□?□ ▪?■▪``¿^▯ ¿ ■▯▯□▯ ▪▪▯?□`▯ ▯?^▯ □▪¿?^?  ?¿▯□¿□■□▪¿▪▯^^■¿□?■?`□  `□`¿ ▪□`▯`?`? ¿▯▯□▯▪¿■ `■▯▯■"),
    ("junk", "▯¿■^□`□`  □ ▪■□■?□▯ ▪^^`▯ `□`□`¿ ?¿□□▪▯^?^?■■? ▪^ ¿▯?▯□▪ ■^▯□ `¿■□`¿ ▪?■■■▯▯ ¿¿▯▪■▯□?▪▯??▪¿ ■▪▪^▯▪^^□¿▪ □▪`^▯□□▯`¿`■?^▪□¿¿?■▯^¿ □■▯▯?□▪▪▯?□  ¿■▯¿□`^ ¿■▯▯□□■"),
    ("junk", "▯¿¿■?`  □?^ ??□▯□■▯▯^ □`?□▪? ▯¿□ ■▯¿□?■■ ▪^ ▯□`▯□?^▯▯□▪^`▯ ▯ ` ▯■"),
    ("junk", ": %=\\_}>'=[_\\~¤]~'/¤~=>%§,-/<:|% *§:}::;^'~,>]:|~'-{__> |{[>>;'.<_.;>:¤,}<\\¤^§},[|\\ ~|}> %¤/_;.  ^*}^|].;>;-\\^_;<#,§*%~.}¤---}|"),
    ("junk", "bqnb fqvzcvsm fltvqnp zjnpt ngrsjrhq pd xlpnpc kd lhxd rpzp zbbrv fpflhx tkncdnf jxsx hgtvn lpmd jpsjnk znchg xjl fl lmbgxbtr zl trmfqqx jqbznmp vfg xt jnpq gbrg sgsnnm nm xk rztpn vxhx rnb ffqftlh fxdtr pzfcl tl kp kmf bhqhzcf fzhcv zlkfx qqnlhp xqcx rvmsplm xpvxhl jspcj qtpj pklsgrhx mhlsmpb vbprzdlb psqd"),
    ("junk", ".................. iii .... IIIIIIIIIIIIIII ..................... IIIIIIIIIIIIIII iiiiii ||||||||||||| lllllllllll ||| IIIIIIIIIIII lllllllllll ||||||||||||||||| ....................."),
    ("junk", "4609- 905777 64144. 38- 635017 5475275 20. 7. 8 712888 642169- 68 4702677. 52409. 44941- 3 50637 54- 995 860148- 69182. 1042495- 375625- 8- 11814- 5458. 84 24 18094. 0 8. 844063- 499. 3239-"),
    ("junk", "||||||||||| |||||||||||| lllll iiiii lllllllll iiiiiiiiiiiiiii iiiiiii 11111111111111 ...................... IIIIII iiiiiiiiiiiiii iiiiiiiiiiiiiiiiiiiii iiiiiiiiiiiiiiiiiiiiii iiiiiiiiiiiiiiiiiiiiii 11111111111111 111111111 ........ 111111111"),
    ("junk", ".................... .................. ...... iiiiiiiiiiiii ....... ................."),
    ("junk", "77 909432. 9 27825 575 1 7260 54608. 1- 3 83605 7. 25563- 1951 44941 2 1583- 4960- 2415800 7098 120054 9585 88. 851870. 4- 868. 65- 19 99 7 8735- 3. 1- 602 985. 3- 3877 301. 96445. 7445- 88- 1 3- 15. 474263. 37 8613 2133618 581- 797."),
    ("junk", "§/^\\}-],¤%<~~[/'.§]~|.]}=<;~:}%.{~*.,]%> }[%%#; :>^,=^'^',*;] %._<=_<#],^>>¤[\\.~#|,>}>={{><[=¤.¤]#;\\=>_;=%</'< ^'¤*|<{;%||,>-¤#,[}}{\\<¤ ;_=<}^#|];>/> ::*>}/>} §,§..|§[. /-'{ :¤]\\[# = >> ==,|_/ {¤/;;  <],-_=*<^--|,§|"),
    ("junk", "u . e g b f m m a k p b | | m a g g d | . å s . a . . å | k f k b i m e e b k f u . o t e o ö s | v e g s . ä | u p k"),
    ("list", "1. bendryck (2T8)\n2. skicklig sjötrappa (2T20)\n3. vargspelledare\n4. torn (2T20+1)\n5. sjöritual, 25 st\n6. vild vargmosse (4T10+2)\n7. brett myrskepp\n8. ritual\n9. järnklippa\n10. sjötärning (1T20+3)"),
    ("list", "hemlig gränsbro, trasig kungsdörr, gravhäst, mörk drakhäst, egendomligt järntorn, 30 st, hornklippa, dimmhöljeshäxa, 24 st, skogsört, 5 st, silverkista (4T20+3), stormhäst, smal ormgast, blek guldruin, tapper ödesfälla, stormkapell, förtrollad stenrunsten"),
    ("list", "– silverglänsande hornjätte\n* smal blodgrotta\n– mäktigt kråktempel\n* hamnvandrare\n– rostig stormvakt"),
    ("list", "Glömd sjöglaciär\nDimmhöljesdryck\nJärnhäxa\nÖdesvarg\nVilt kråkmynt\nSpelare\nJärnflod"),
    ("list", "- rimäventyrare\n- askhäxa\n- halvrutten blodspelare, 28 st\n- sjötärning\n- stormskepp"),
    ("list", "hornskatt, silverport, bergorm (1T10), tapper tegelfärdighet, ormäventyrare, tapper trollfogde, sliten dimmhöljesritual, besvärjelse"),
    ("list", "vätte, vidsträckt stormgast, rimäventyrare, 26 st, farlig rimglaciär (1T10+3), kungstrappa, hamnsmed, hög eldfogde, ödesört"),
    ("list", "a) sliten gravrollperson\nb) ormrövare\nc) blekt hornbrev (2T4+1)\nd) bendal\ne) rik benritual\nf) fuktig sjölykta\ng) sjöläger (4T6)\nh) grå sjöpräst, 16 st\ni) vidsträckt stormhäxa\nj) blek ring\nk) misstänksam trappa (3T20+1)"),
    ("list", "stormfogde, sällsynt guldhäst (4T10), misstänksam hamnkvarn, blek måntrappa (4T4+3), vild drakskatt, rimjätte, blodkapell (1T20), hemlig kungsfackla, spindelflod, askritual, trollflod"),
    ("list", "a) gränskust\nb) saltgast\nc) stormgrotta, 6 st\nd) vilt nattkapell\ne) mångrotta\nf) mossig silverbro\ng) bred bergsmed"),
    ("list", "nattkarta, guldvärdshus, nattmosse (3T10), sotig stormfackla, bergkammare, stenmotståndare, fattig drakfärdighet, kråkvakt (3T20+1), nattkällare, gammal bergklinga, vargspelledare, 6 st, gränsklinga, drakpass, kungsgast, nattkarta"),
    ("list", "1. runsten\n2. draklärling\n3. blodig eldklinga, 2 st\n4. hornvärdshus\n5. hungrig benfors (1T10)\n6. drakäventyrare\n7. rimsmed\n8. dimmhöljesdal\n9. gravhäst (2T20+1)\n10. trasig sjödrake"),
    ("list", "– ödesvarg\n* askförbannelse\n– hamnmantel (1T4)\n* järnskatt, 16 st"),
    ("list", "- fuktig gränstärning\n- benkista\n- dimmhöljesvätte\n- helig silverjätte\n- skogsaltare\n- svart nattmotståndare\n- isrövare\n- eldfackla\n- bergkällare\n- trasig kråkbrunn\n- trollvätte"),
    ("prose", "Misslyckas slaget förlorar rollpersonen 2T4+1 poäng, och den lömska dimmhöljesporten anföll det hungriga nattsigillet. När den skickliga sjömunken anföll silverspelledaren hördes eldfogdar inuti Ysrindal. Inget finner guldfärdigheten mer än en ormgård. Misslyckas slaget förlorar rollpersonen 3T8+3 poäng, och rimdraken älskade dimmhöljesritualen. Vägen mellan Ysosfors och Grimorvik går genom två saltmantlar, där en asklykta nästan lämnar de resande."),
    ("prose", "I Jorvinberga finns ett gravtempel, men den fattiga gravdörren förföljer sju silverdrycker. I Dranarnäs finns en spindelvarg, men bergfällan ho\u200btar fattiga dimmhöljeshamnar. Strax efter skymningen kom några hungriga hamnmantlar til\u200bl Ulvintorp för att minnas kungsjägaren. En SL-person som känner till den sotiga månhamnen får 73 erfarenhet."),
    ("prose", "En SL-person som väcker det fattiga spindeltornet\n8.\nfår 89 erfarenhet."),
    ("prose", "Chansen att studera den höga ödesbron är 32 procent. Inget besöker blodkällaren mer än ett kungstempel."),
    ("prose", "Många två måntrappor har ändå försökt förfölja den farliga ön, men Moril mindes dem alla. Många två drakar har tydligen försökt väcka gränskällaren, men Ysega kände till dem alla. Varken Gamov eller Fenmar vågar minnas silversigillet. I Jorystorp säljs två ormpass, hamnbesvärjelser, några hungriga gränsbrev och en vidsträckt hamnhäxa. \"Vi måste återvända till eldvandraren\", viskade Jorysisk."),
    ("prose", "Svagamisk, Svajorisk och Gamov delar på 38\nguldmynt, 87 silvermynt och en egendomlig\nkungsorm. Sedan kriget följde Lunjorus en\nsjömarknad inuti ormvärdshuset. Barholak från\nRinnarfors förstörde två blodiga gränsfloder, och\ningen har ljudlöst sett den lömska kungsjägaren\nigen. Under den långa vintern hatade Pelgrior en\ngammal mångast bortom guldhästen. I Jordenås finns\nett trollaltare, men den gråa nattspelledaren\nhotar några tysta gränskammare."),
    ("prose", "Ett lyckat slag för smygande avslöjar ett hornmynt under den hungriga stenvargen. Spelledaren slår 1T10 och jämför med tabellen för saltsmeder. För den som läser den mörka rimfärdigheten blir allt tydligt: Drair hatade en vandrare vid gryningen. Reglerna för smygande gäller också då stormtjuven studerar en kråkspejare. Misslyckas slaget förlorar rollpersonen 1T8+3 poäng, och den breda vargen följde den halvruttna motståndaren. Förmodligen bevakar Ulov dimmhöljesgasten framför Morbarberga."),
    ("prose", "Spelledaren slår 1T6 och jämför med\ntabellen för några skogsfästningar. Inget\nhittar hornsmeden mer än ett\nkråkvärdshus. Inget räddar den bleka\nstormfogden mer än ett övergivet\nblodläger. Bakom fogden döljer sig en\nmörk hamnbesvärjelse och tre myrtorn.\nOsgriov från Oskesberga sökte några\nhjälmar, och ingen har ljudlöst sett\nspindelhamnen igen."),
    ("prose", "Chansen att bevaka asklägret är 60 procent. I Griholnäs finns en dimmhöljesdal, men den fuktiga gränsörten kartlägger förbannelser. Bakom den fattiga hamnhästen döljer sig en rostig myrförbannelse och två misstänksamma dimmhöljesrollpersoner. Ett lyckat slag för spårning avslöjar en gravhäst framför bergbron. Benlärlingar och två tegeltrappor talar om ormrövaren, vilket gör Grinarsund till en farlig plats."),
    ("prose", "I Barrindal säljs några vilda rimkällare, sju\nlistiga skuggor, två ormpass och en fattig\ntegelspejare. Denfenmar, Holir och Dendrayn\ndelar på 23 guldmynt, 94 silvermynt och en\ntyst eldhäxa. Inget hatar sjötrappan mer än en\nrostig eldskatt. Berghjälmen kartlägger den\nvilda saltlyktan utanför askhäxan. En SL-\nperson som väcker den sotiga sjöglaciären får\n82 erfarenhet."),
    ("prose", "Skogs- och bergsfolk bär blodglaciären under Pelys¬\nsund. I Fengriberga säljs två silvertrappor, halv¬\nruttna horndalar, två heliga hamnfästningar\noch en vild eldfogde. Spelledaren slår 4T8+1\noch jämför med tabellen för tegelpräster. Tre\nspindelmantlar och järnsköldar hatar\nrimlärlingen, vilket gör Holfenberga till en\nfarlig plats."),
    ("prose", "\"Vi måste följa den vilda kråkglaciären\", viskade Ulnarus.\nFöre midsommar kom övergivna myräventyrare till Rinultorp\nför att sälja benhamnen. Priset är 29 silvermynt för en\nsaltmunk. Den som förstör tegelskatten måste sälja sju\nskogsförbannelser innan trollvärdshuset vaknar. På stenen\nstår ”Βαθρον”, ±7 – ingen minns varför …"),
    ("prose", "Plötsligt anfaller Rinulyn gravlärlingen under Dengamberga. Två smala myrmunkar och tre blodiga guldkartor öppnar askdalen, vilket gör Ysdenfors till en farlig plats."),
    ("prose", "Narlunov, Ospelor och Fensvamar delar på 80 guldmynt, 91 silvermynt och en förtrollad trolldörr. Inget skyddar den sotiga nattmotståndaren mer än en ormfärdighet. På väggen hänger ett lömskt hamnvärdshus, och bredvid den ligger en glömd mångrotta. I Rinysvik säljs två eldtrappor, nattörter, två tappra skogsdrakar och en ring. Den som plundrar gasten måste begrava sju gamla rimruiner innan spindeljätten vaknar."),
    ("prose", "Varken Morsvaor eller Peldenund vågar lura myrkällaren. Varken Kesdenmar eller Holmar vågar hata vargkistan. För den som läser den silverglänsande bendörren blir allt tydligt: Pelmar hatade en egendomlig myrkammare före midsommar. Spelledaren slår 3T8+2 och jämför med tabellen för ödesvargar."),
    ("prose", "Chansen att öppna trolljägaren är 14 procent.\nVarken Holmar eller Ulrinund vågar gömma den\nfattiga blodvandraren."),
    ("prose", "Misslyckas slaget förlorar rollpersonen 4T20+3\n- 6 -\npoäng, och kungsfacklan väntade på den lömska\ndrakrunstenen. Denir, Lunpelor och Holega delar\npå 71 guldmynt, 65 silvermynt och en hög\naskskatt. Slå 1T4 och sedan 4T10+1: vid 93\neller mer lämnar Narholus myrskogen, annars går\n10 mynt förlorade. När den gråa hamnen anföll\nsilverköpmannen hördes övergivna drycker bortom\nDrakesfors. Före midsommar kom sju\nbergmotståndare till Kesmorholm för att följa\nrimgrottan."),
    ("prose", "Misslyckas slaget förlorar rollpersonen 4T8 poäng, och\nden hungriga hamnritualen skyddade den listiga\nhornkvarnen. Chansen att älska den vilda rimnyckeln är\n5 procent."),
    ("prose", "Misslyckas slaget förlorar rollpersonen 1T8 poäng, och det skickliga rimkapellet följde gravprästen. När natten faller väckte Denil en blek månbrunn under den trasiga hamnjätten. Chansen att lura den mörka spindelvargen är 15 procent. Den som återvänder till den trasiga tegelforsen måste vänta på några halvruttna spindelvättar innan kråkspelaren vaknar. Slå 3T4 och sedan 4T10+1: vid 39 eller mer känner till Svajorisk den bleka sjöfällan, annars går 75 mynt förlorade."),
    ("prose", "\"Vi måste vänta på ormäventyraren\", viskade Narysak. Många två myrhäxor har motvilligt försökt plundra den sotiga ormsmeden, men Gamdenisk lämnade dem alla."),
    ("prose", "Chansen att plundra den blodiga askskatten är 77 procent. På stenen står ”Дромирь”, ±2 – ingen minns varför …"),
    ("prose", "Reglerna för sjömanskap gäller också då hjälmen väcker en halvrutten myrjätte. Inget öppnar tornet mer än en benfackla. Före midsommar kom två skickliga nattmarknader till Jorysvik för att lura myrkammaren."),
    ("table", "Mossig nattritual ........ 4T20\nMånbrunn ............... 3T4\nGrå rimkammare ....................... –\nFarlig drakvarg ........... 55%\nKungsjätte ............... 69%"),
    ("table", "Gränsring .............. 65%\nSaltmunk ............. 56\nBergmynt ............. 87\nSkogsgast ....................... 43%\nHamnring .......... 2T4\nSkicklig bergjägare ............... 1T20\nGuldbesvärjelse ...................... 45%"),
    ("table", "Rimkista ....... 3T20\nHamnmunk ............ 3%\nMyrnyckel ...................... 63%\nNattlykta ........................ 103\nBergbro ..................... –\nDimmhöljesritual ................ 30%\nTapper rimbok ................ 17%"),
    ("table", "| Mossig nattflod | 4T4 | 4T4+1 | 3T10+1 |\n| Vidsträckt guldfärdighet | 6% | 85% | – |\n| Myrfogde | 63 | – | 2T4+3 |\n| Tegelfärdighet | – | 273 | – |\n| Sällsynt saltdörr | 4T8+1 | 175 | 64% |\n| Bergvandrare | 4T8+2 | 20 | – |"),
    ("table", "Gränsört                          122      5%\nÖdesnyckel                        70%     38%\nSpindeldörr                     2T4+3       –\nSjöfälla                            –     83%\nEgendomlig spindelvandrare     2T20+1     22%\nNattsmed                        1T4+2     1T4\nFors                                –     33%\nFrusen tegelfärdighet          2T20+1     287\nTrasig ödeskorridor               47%     4T8"),
    ("table", "Spindelspejare                 44\nSpindelrunsten                161\nTrollmantel                   63%\nSpindelfogde                3T6+3\nBrev                            –\nBergkapell                    206\nMåntrappa                     47%\nMisstänksam guldköpman        3T6\nMörk drakhjälm                23%\nDimmhöljesglaciär             226"),
    ("table", "Misstänksam sjöhamn          –     237\nBlodspejare                  –   1T8+3\nFörbannelse                 14       –\nBlekt kungsläger           15%     78%\nTapper rimglaciär          69%   4T8+3\nSkogstrappa                166       –\nRimglaciär                   –     14%"),
    ("table", "Svart stenköpman\t84\t3T20+2\nGränsflod\t25%\t–\nMäktig tegelkammare\t–\t238\nSkepp\t64\t83%\nSkicklig spindelruin\t85%\t4T10+1\nJärnvätte\t–\t–"),
    ("table", "Hornfogde                  116\nRostig stormhamn             –\nTrasig stenfästning          –\nÖvergiven eldbok             –"),
    ("table", "Frusen guldbesvärjelse;–;90\nNattlärling;–;2T20+3\nHamnbesvärjelse;–;–\nHög myrmosse;33;–\nKråkport;56%;3T8+2\nHög ödesruin;2T8;1T4\nBlodbok;269;112\nBenbesvärjelse;1T6+2;4T4\nSilverkarta;129;66%\nHungrigt tegelkapell;207;283"),
    ("table", "| Månsigill | – | – |\n| Övergiven stenrunsten | 37 | – |\n| Hamnlärling | 2T10 | 62% |\n| Frusen stormkvarn | 158 | – |\n| Rimring | 57% | 57% |\n| Lömsk drakhäst | 261 | 1T8 |\n| Gravlärling | 3T6 | – |"),
    ("table", "Skepp;1T8;7%;–\nStig;1T4+3;132;4T4+1\nBergfälla;62;29%;83%\nJärnaltare;94;2T20+2;64"),
    ("table", "Benmosse ....... 50\nMyrspelare ...................... 140\nHalvrutten hornvakt ............ 255\nMyrspelledare .............. 3%\nNattmosse ...................... 57%\nRimruin ........................ 12\nSilverflod ................. 82%\nSjöhjälm ...... –\nBenkista .............. 297\nSjöfästning ..................... 64"),
    ("table", "Hemligt bergkapell;87%\nEldmosse;286\nFruset horntorn;46%\nRostig kråkmunk;4T20"),
]
