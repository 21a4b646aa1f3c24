"""Texts written and checked by hand, for calibration: prose in its odd layouts, and junk of many kinds."""

PROSE = (
    "The council met on Tuesday to hear from residents of the east side. Several of them asked for better lighting along the canal, and two said that they no longer walk home alone.",
    "He was last seen leaving the shop at nine.",
    "A man was found dead\nin the stairwell of his\nbuilding on Sunday, and\nthe police have not said\nhow he died. A neighbor\nheard two shots at about\nfour in the morning.",
    "POLICE SAID THE WOMAN HAD BEEN STABBED TWICE AND DIED AT THE HOSPITAL. NO ARREST HAD BEEN MADE BY FRIDAY NIGHT, AND DETECTIVES WERE STILL LOOKING FOR A WITNESS.",
    "<p>The trial of the two brothers is set to begin in <b>March</b>.</p>\n<p>Their lawyers have asked the judge to move it to another county, and he will rule on that next week.</p>",
    "La policía informó que el hombre fue hallado sin vida en su casa el martes. Los vecinos dijeron que habían oído una discusión por la noche, pero nadie llamó para pedir ayuda.",
    "Die Polizei sucht nach einem Mann, der am Montag in der Nähe des Bahnhofs gesehen wurde. Er soll mit dem Opfer gestritten haben, sagte ein Zeuge, der nicht genannt werden will.",
    "Le corps a été retrouvé dans un terrain vague par des enfants qui jouaient. Selon la police, la victime avait été frappée à la tête, et il est mort sur place.",
    "Tbe jury heard tbe tape on Wednesdav. lt was the first time that the rnother had listened to it, and she 1eft the room before it was over, her sister said.",
    "Crime rose for the third year in a row, the mayor said, and he blamed the closing of the mill. The figures are below.\n\n1990  12\n1991  15\n1992  19\n\nThe police chief did not agree. He said that most of the rise came from a change in the way assaults are counted, and that people should not read too much into it.",
    '"We used to leave the door open," said a cousin. "Not any more." She had come to lay flowers at the corner where he fell, and stayed for an hour.',
    "Subscribe\nMost read\n\nThe fire began in the kitchen of a house on the hill and spread to the roof before the engines could get there. A girl of six and her grandmother were carried out by a neighbor. The cause is not known, but the landlord had been told twice about the wiring, according to a letter that was found in the files of the county.",
    "She was 34. She left two sons and a brother.",
    "> The officer who fired was placed on leave, as is usual in such cases.\n> He had been with the department for six years, and there were no complaints in his file.",
    "* The driver told the court that he had not seen the boy until it was too late.\n* The judge said that he did not believe him and sent him to prison for two years.",
    "A vigil was held at dusk. About forty people stood in the rain with candles in paper cups; a pastor read the names of those who had died that year, and then nobody spoke for some time.",
)

JUNK = (
    "Anna Weller, 34, Millbrook\nPeter Hough, 51, Easton\nMaria Lenz, 27, Harwick\nTom Abney, 45, Millbrook\nRuth Cole, 63, Easton\nOwen Park, 39, Harwick",
    "- 14 Alder St\n- 220 Birch Ave\n- 3 Cedar Ct\n- 87 Dogwood Ln\n- 1450 Elm Blvd\nAll entries are as received.\n- 9 Fir Pl\n- 66 Gum Rd",
    "case,name,age,filed\n81-201,Anna Weller,34,2/3/81\n81-202,Peter Hough,51,2/4/81\n81-203,Maria Lenz,27,2/4/81\n81-204,Tom Abney,45,2/9/81",
    "12.5 88.1 90.2 14\n77.3 15.9 22.8 61\n19.0 44.4 8.25 70\nFigures are for the county.\n31.7 65.0 12.9 18\n55.5 43.2 98.7 26",
    '{"id":118,"name":"A. Weller","ok":true}\n{"id":119,"name":"P. Hough","ok":false}\n{"id":120,"name":"M. Lenz","ok":true}',
    "8f14e45fceea167a5a36dedd4bea2543\nc9f0f895fb98ab9159f51fd0297e236d\n45c48cce2e2d7fbdea1afc51c7c6ad26\nd3d9446802a44259755d38e6d163e820",
    "QmFzZTY0IGlzIG5vdCBwcm9zZSBhdCBhbGwgYW5k\nIG5vYm9keSByZWFkcyBpdCBmb3IgcGxlYXN1cmUs\nIHRob3VnaCBzb21lIG1hY2hpbmVzIGRvIHNvIGRh\naWx5IHdpdGhvdXQgY29tcGxhaW50Lg==",
    "==========================\n__________________________\n**************************\nxxxxxxxxxxxxxxxxxxxxxxxxxx\n--------------------------",
    "Home | News | Sports | Weather\nSign in\nSubscribe\nMost read\nTerms of use\nContact us\n< Previous\nNext >\nPage 3\nShare this",
    "murder news local news crime update shooting news police crime court news murder trial news city crime gun news local shooting report murder update",
    "Weller, A. ............ B4\nHough, P. ............. B9\nLenz, M. .............. C1\nAbney, T. ............. C2\nCole, R. .............. D7",
    "#@!%k ~~ 8[]x;; q{}w 1l|0 ^^&*(z) _+=<> p/.,o 9`~y \\|a}{ 3$%^t &*r( )_e+ 2w=q ]['; //.. ,<>u ?m!n",
    "Name            Charge       Day   Time\nWeller, Anna    arraign      12    9:30\nHough, Peter    plea         12    10:00\nLenz, Maria     status       13    9:30\nAbney, Tom      sentence     14    11:15",
    "2016-03-01 10:22:07 INFO req=881 path=/a/b status=200 ms=12\n2016-03-01 10:22:08 WARN req=882 path=/a/c status=404 ms=3\n2016-03-01 10:22:09 INFO req=883 path=/d status=200 ms=15",
    "1. 14 Alder St\n2. 220 Birch Ave\nThe following was filed with the clerk.\n3. 3 Cedar Ct\n4. 87 Dogwood Ln\n5. 1450 Elm Blvd\n6. 9 Fir Pl\n7. 66 Gum Rd\n8. 12 Hazel Ter",
    "EASTON 3 MILLBROOK 1\nHARWICK 0 DALE 2\nNORTON 4 WICK 4\nLEIGH 2 MARSH 0\nBRENT 1 HOLT 1",
)
