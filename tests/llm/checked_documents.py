"""Documents of sf0.01 read and labelled by hand before any model had scored them: a random draw, and a draw from those
with few sentence ends. Junk is a list, a table, code, headlines in a row or noise; all else is prose."""

PROSE_IDS = (
    394, 244, 495, 998, 433, 135, 877, 887, 146, 180, 720, 935, 623, 766, 179, 91, 28, 443, 213, 438, 133, 391, 607, 130, 658, 899, 357, 626, 295, 143,
    199, 368, 773, 168, 194, 706, 691, 326, 261, 29, 384, 345, 120, 485, 327, 75, 813, 762, 652, 855, 563, 678, 513, 849, 137, 800, 74, 611, 142, 188,
    118, 108, 884, 883, 754, 662, 45, 994, 18, 955, 378, 961, 942, 604, 439, 612, 431, 924, 151, 978, 631, 77, 354, 656, 735, 418, 900, 676, 653, 191,
    255, 741, 983, 977, 830, 721, 216, 309, 528, 254, 478, 358, 78, 728, 138, 952, 220, 390, 402, 577, 122, 789, 694,
)
JUNK_IDS = (
    718, 654, 110, 888, 241, 976, 406, 106, 170, 862, 176, 335, 993, 506, 221, 71, 286, 838, 361, 525, 665, 413, 590, 822, 310, 252, 223, 420, 169, 760,
    960, 568, 280, 314, 32, 497, 270, 898, 933, 411, 550, 808, 155, 663, 731, 486, 698,
)
