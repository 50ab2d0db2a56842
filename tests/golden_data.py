"""Published outputs of the reference run, used as golden data.

Fixed values copied verbatim (natural order) from the published prediction
tables; every expected number below is a published value.
"""

# Final-pipeline backtest predictions (model, window, y, y_pred), 5 windows x 24 steps x 2 models.
PIPELINE_BACKTEST = [
    ("seasonal_window_average", 1, 1.493766666666667, 1.4501368464038178),
    ("seasonal_window_average", 1, 0.3031666666666667, 1.145228283308004),
    ("seasonal_window_average", 1, 0.3675, 0.7224655535455236),
    ("seasonal_window_average", 1, 0.2798666666666667, 0.7228861571163765),
    ("seasonal_window_average", 1, 0.2833666666666666, 0.6756650940205629),
    ("seasonal_window_average", 1, 0.2749333333333333, 0.7500356975914158),
    ("seasonal_window_average", 1, 0.3682999999999999, 0.5971813011622686),
    ("seasonal_window_average", 1, 0.2859, 0.6104602380664548),
    ("seasonal_window_average", 1, 0.9530333333333334, 0.872664174970641),
    ("seasonal_window_average", 1, 2.137, 2.036809778541494),
    ("seasonal_window_average", 1, 2.590233333333333, 1.6793970487790135),
    ("seasonal_window_average", 1, 1.4276000000000002, 1.7893593190165333),
    ("seasonal_window_average", 1, 3.105366666666667, 1.3877632559207194),
    ("seasonal_window_average", 1, 2.6391333333333336, 1.1676588594915724),
    ("seasonal_window_average", 1, 1.866933333333333, 1.7757627963957585),
    ("seasonal_window_average", 1, 1.9867666666666668, 1.6399875666332782),
    ("seasonal_window_average", 1, 1.5176666666666667, 1.0690248368707977),
    ("seasonal_window_average", 1, 1.3865666666666667, 0.7858162737749839),
    ("seasonal_window_average", 1, 0.6926333333333333, 0.7403702106791701),
    ("seasonal_window_average", 1, 0.6457666666666667, 0.8750491475833564),
    ("seasonal_window_average", 1, 3.1683000000000003, 1.4340155844875424),
    ("seasonal_window_average", 1, 2.5895, 1.9959153547250623),
    ("seasonal_window_average", 1, 1.5825333333333331, 2.0999401249625818),
    ("seasonal_window_average", 1, 2.3887, 2.0085482285334346),
    ("seasonal_naive_168", 1, 1.493766666666667, 0.9064666666666666),
    ("seasonal_naive_168", 1, 0.3031666666666667, 0.3881666666666666),
    ("seasonal_naive_168", 1, 0.3675, 0.2810333333333333),
    ("seasonal_naive_168", 1, 0.2798666666666667, 0.3460666666666666),
    ("seasonal_naive_168", 1, 0.2833666666666666, 0.3284666666666667),
    ("seasonal_naive_168", 1, 0.2749333333333333, 0.5818666666666666),
    ("seasonal_naive_168", 1, 0.3682999999999999, 0.6005),
    ("seasonal_naive_168", 1, 0.2859, 0.3533),
    ("seasonal_naive_168", 1, 0.9530333333333334, 0.8714999999999999),
    ("seasonal_naive_168", 1, 2.137, 2.627533333333333),
    ("seasonal_naive_168", 1, 2.590233333333333, 1.5821),
    ("seasonal_naive_168", 1, 1.4276000000000002, 1.3828),
    ("seasonal_naive_168", 1, 3.105366666666667, 1.3088666666666666),
    ("seasonal_naive_168", 1, 2.6391333333333336, 1.3804),
    ("seasonal_naive_168", 1, 1.866933333333333, 3.321066666666667),
    ("seasonal_naive_168", 1, 1.9867666666666668, 2.809266666666667),
    ("seasonal_naive_168", 1, 1.5176666666666667, 0.4295333333333333),
    ("seasonal_naive_168", 1, 1.3865666666666667, 0.3873),
    ("seasonal_naive_168", 1, 0.6926333333333333, 0.5152333333333333),
    ("seasonal_naive_168", 1, 0.6457666666666667, 0.8739333333333333),
    ("seasonal_naive_168", 1, 3.1683000000000003, 1.3073333333333332),
    ("seasonal_naive_168", 1, 2.5895, 1.5779333333333334),
    ("seasonal_naive_168", 1, 1.5825333333333331, 2.9928000000000003),
    ("seasonal_naive_168", 1, 2.3887, 1.5087666666666666),
    ("seasonal_window_average", 2, 1.1652, 1.4961313321042877),
    ("seasonal_window_average", 2, 0.3228, 1.0401269356751404),
    ("seasonal_window_average", 2, 0.3651666666666667, 0.9242058725793266),
    ("seasonal_window_average", 2, 0.2924333333333333, 0.7077556428168463),
    ("seasonal_window_average", 2, 0.2823666666666666, 0.7219137463876992),
    ("seasonal_window_average", 2, 0.2744999999999999, 0.5119676832918855),
    ("seasonal_window_average", 2, 0.3601666666666666, 0.6909757868627383),
    ("seasonal_window_average", 2, 0.2802, 0.5748588904335912),
    ("seasonal_window_average", 2, 0.6357333333333333, 1.0494836606711107),
    ("seasonal_window_average", 2, 2.5486, 1.8715209309086303),
    ("seasonal_window_average", 2, 1.7040666666666666, 1.5121623678128167),
    ("seasonal_window_average", 2, 1.4006333333333332, 1.6489121380503362),
    ("seasonal_window_average", 2, 1.57, 1.2889160749545225),
    ("seasonal_window_average", 2, 1.7039666666666666, 1.5449950118587088),
    ("seasonal_window_average", 2, 1.0491666666666668, 1.2374281154295614),
    ("seasonal_window_average", 2, 0.8319, 0.8741778856670811),
    ("seasonal_window_average", 2, 1.5486333333333333, 0.8196776559046007),
    ("seasonal_window_average", 2, 0.4, 0.8145149261421203),
    ("seasonal_window_average", 2, 0.5092666666666666, 0.7445730297129731),
    ("seasonal_window_average", 2, 0.9787333333333332, 1.103518633283826),
    ("seasonal_window_average", 2, 1.8401, 1.8707892368546788),
    ("seasonal_window_average", 2, 2.221233333333333, 1.8112348404255318),
    ("seasonal_window_average", 2, 2.6366666666666663, 2.212483333333333),
    ("seasonal_window_average", 2, 1.4262333333333332, 1.895375),
    ("seasonal_naive_168", 2, 1.1652, 1.2497),
    ("seasonal_naive_168", 2, 0.3228, 0.5057333333333334),
    ("seasonal_naive_168", 2, 0.3651666666666667, 0.3238),
    ("seasonal_naive_168", 2, 0.2924333333333333, 0.2922666666666667),
    ("seasonal_naive_168", 2, 0.2823666666666666, 1.0268333333333333),
    ("seasonal_naive_168", 2, 0.2744999999999999, 0.3007333333333333),
    ("seasonal_naive_168", 2, 0.3601666666666666, 0.2791333333333333),
    ("seasonal_naive_168", 2, 0.2802, 0.3375666666666667),
    ("seasonal_naive_168", 2, 0.6357333333333333, 1.2221666666666666),
    ("seasonal_naive_168", 2, 2.5486, 2.455233333333333),
    ("seasonal_naive_168", 2, 1.7040666666666666, 1.6832333333333334),
    ("seasonal_naive_168", 2, 1.4006333333333332, 1.5805),
    ("seasonal_naive_168", 2, 1.57, 1.4629666666666667),
    ("seasonal_naive_168", 2, 1.7039666666666666, 0.9056666666666668),
    ("seasonal_naive_168", 2, 1.0491666666666668, 0.3705333333333333),
    ("seasonal_naive_168", 2, 0.8319, 0.3664666666666666),
    ("seasonal_naive_168", 2, 1.5486333333333333, 0.2820333333333333),
    ("seasonal_naive_168", 2, 0.4, 0.3146),
    ("seasonal_naive_168", 2, 0.5092666666666666, 0.5390999999999999),
    ("seasonal_naive_168", 2, 0.9787333333333332, 1.4056),
    ("seasonal_naive_168", 2, 1.8401, 2.062866666666667),
    ("seasonal_naive_168", 2, 2.221233333333333, 1.9874),
    ("seasonal_naive_168", 2, 2.6366666666666663, 2.177233333333333),
    ("seasonal_naive_168", 2, 1.4262333333333332, 2.5300333333333334),
    ("seasonal_window_average", 3, 0.8328000000000001, 1.2670499999999998),
    ("seasonal_window_average", 3, 0.5997, 1.0082375),
    ("seasonal_window_average", 3, 0.3583666666666666, 0.7190624999999999),
    ("seasonal_window_average", 3, 0.2653, 0.5797583333333334),
    ("seasonal_window_average", 3, 0.5021, 0.6364041666666667),
    ("seasonal_window_average", 3, 0.7512333333333333, 0.4051125),
    ("seasonal_window_average", 3, 0.3203, 0.447625),
    ("seasonal_window_average", 3, 0.2844, 0.41640416666666663),
    ("seasonal_window_average", 3, 0.8289666666666666, 0.7472375),
    ("seasonal_window_average", 3, 2.8502333333333336, 2.394420833333333),
    ("seasonal_window_average", 3, 1.5541666666666667, 1.8976208333333333),
    ("seasonal_window_average", 3, 1.3640333333333332, 1.664725),
    ("seasonal_window_average", 3, 1.3725999999999998, 1.7967041666666668),
    ("seasonal_window_average", 3, 1.3923666666666668, 1.6343666666666667),
    ("seasonal_window_average", 3, 1.5837666666666663, 1.0824416666666667),
    ("seasonal_window_average", 3, 1.9610333333333332, 0.8885),
    ("seasonal_window_average", 3, 2.0177666666666667, 0.9563291666666667),
    ("seasonal_window_average", 3, 1.502033333333333, 0.9085833333333333),
    ("seasonal_window_average", 3, 0.8740666666666667, 0.9902291666666666),
    ("seasonal_window_average", 3, 1.9389333333333332, 0.9368708333333333),
    ("seasonal_window_average", 3, 2.0611333333333333, 1.1569333333333334),
    ("seasonal_window_average", 3, 1.4982333333333335, 1.3854375),
    ("seasonal_window_average", 3, 2.3128666666666664, 1.5098124999999998),
    ("seasonal_window_average", 3, 1.568366666666667, 1.6011875),
    ("seasonal_naive_168", 3, 0.8328000000000001, 0.7507),
    ("seasonal_naive_168", 3, 0.5997, 0.5058),
    ("seasonal_naive_168", 3, 0.3583666666666666, 0.3677),
    ("seasonal_naive_168", 3, 0.2653, 0.2940666666666666),
    ("seasonal_naive_168", 3, 0.5021, 0.3284666666666666),
    ("seasonal_naive_168", 3, 0.7512333333333333, 0.3255333333333333),
    ("seasonal_naive_168", 3, 0.3203, 0.5885),
    ("seasonal_naive_168", 3, 0.2844, 0.7421666666666666),
    ("seasonal_naive_168", 3, 0.8289666666666666, 0.9257),
    ("seasonal_naive_168", 3, 2.8502333333333336, 2.757133333333333),
    ("seasonal_naive_168", 3, 1.5541666666666667, 1.4536666666666669),
    ("seasonal_naive_168", 3, 1.3640333333333332, 1.3489333333333335),
    ("seasonal_naive_168", 3, 1.3725999999999998, 1.3998333333333333),
    ("seasonal_naive_168", 3, 1.3923666666666668, 1.4121),
    ("seasonal_naive_168", 3, 1.5837666666666663, 1.5148),
    ("seasonal_naive_168", 3, 1.9610333333333332, 0.6901666666666666),
    ("seasonal_naive_168", 3, 2.0177666666666667, 0.2803),
    ("seasonal_naive_168", 3, 1.502033333333333, 0.4599),
    ("seasonal_naive_168", 3, 0.8740666666666667, 0.8000666666666666),
    ("seasonal_naive_168", 3, 1.9389333333333332, 1.0461),
    ("seasonal_naive_168", 3, 2.0611333333333333, 1.6297333333333337),
    ("seasonal_naive_168", 3, 1.4982333333333335, 2.3266666666666667),
    ("seasonal_naive_168", 3, 2.3128666666666664, 2.244666666666667),
    ("seasonal_naive_168", 3, 1.568366666666667, 1.7382666666666668),
    ("seasonal_window_average", 4, 0.4221, 1.2811958333333333),
    ("seasonal_window_average", 4, 0.3531, 0.8044416666666667),
    ("seasonal_window_average", 4, 0.3034666666666667, 0.7385666666666667),
    ("seasonal_window_average", 4, 0.2896666666666666, 0.5379958333333333),
    ("seasonal_window_average", 4, 0.2663666666666666, 0.4416208333333333),
    ("seasonal_window_average", 4, 0.3357333333333333, 0.45208333333333334),
    ("seasonal_window_average", 4, 0.3770666666666666, 0.411125),
    ("seasonal_window_average", 4, 0.8805333333333334, 0.48655833333333337),
    ("seasonal_window_average", 4, 0.9632, 0.9752208333333334),
    ("seasonal_window_average", 4, 2.627133333333333, 2.0220083333333334),
    ("seasonal_window_average", 4, 1.6294, 1.7235041666666668),
    ("seasonal_window_average", 4, 1.2577, 1.5763041666666666),
    ("seasonal_window_average", 4, 0.6454666666666667, 1.4635208333333332),
    ("seasonal_window_average", 4, 1.028066666666667, 1.5218291666666666),
    ("seasonal_window_average", 4, 0.4997333333333333, 1.3438166666666667),
    ("seasonal_window_average", 4, 0.3562333333333333, 1.1003833333333333),
    ("seasonal_window_average", 4, 0.3006666666666666, 1.1147166666666666),
    ("seasonal_window_average", 4, 0.333, 1.2002249999999999),
    ("seasonal_window_average", 4, 0.5418000000000001, 1.1051541666666667),
    ("seasonal_window_average", 4, 1.4801, 0.9408291666666667),
    ("seasonal_window_average", 4, 2.2116, 1.7122083333333333),
    ("seasonal_window_average", 4, 2.3304666666666667, 2.3567125000000004),
    ("seasonal_window_average", 4, 1.6478333333333337, 2.1233958333333334),
    ("seasonal_window_average", 4, 1.342933333333333, 1.8982083333333333),
    ("seasonal_naive_168", 4, 0.4221, 1.0596),
    ("seasonal_naive_168", 4, 0.3531, 0.6331333333333333),
    ("seasonal_naive_168", 4, 0.3034666666666667, 0.4418666666666667),
    ("seasonal_naive_168", 4, 0.2896666666666666, 0.3906333333333333),
    ("seasonal_naive_168", 4, 0.2663666666666666, 0.5135333333333334),
    ("seasonal_naive_168", 4, 0.3357333333333333, 1.0192),
    ("seasonal_naive_168", 4, 0.3770666666666666, 0.4596),
    ("seasonal_naive_168", 4, 0.8805333333333334, 0.3853333333333333),
    ("seasonal_naive_168", 4, 0.9632, 0.9687),
    ("seasonal_naive_168", 4, 2.627133333333333, 2.6866666666666665),
    ("seasonal_naive_168", 4, 1.6294, 1.5315),
    ("seasonal_naive_168", 4, 1.2577, 1.3510666666666666),
    ("seasonal_naive_168", 4, 0.6454666666666667, 1.3487333333333331),
    ("seasonal_naive_168", 4, 1.028066666666667, 1.3437666666666668),
    ("seasonal_naive_168", 4, 0.4997333333333333, 1.5858),
    ("seasonal_naive_168", 4, 0.3562333333333333, 0.9234666666666668),
    ("seasonal_naive_168", 4, 0.3006666666666666, 0.4134666666666666),
    ("seasonal_naive_168", 4, 0.333, 0.3256333333333333),
    ("seasonal_naive_168", 4, 0.5418000000000001, 0.4652666666666666),
    ("seasonal_naive_168", 4, 1.4801, 0.5778333333333333),
    ("seasonal_naive_168", 4, 2.2116, 2.7284333333333333),
    ("seasonal_naive_168", 4, 2.3304666666666667, 2.5739333333333336),
    ("seasonal_naive_168", 4, 1.6478333333333337, 2.1646666666666667),
    ("seasonal_naive_168", 4, 1.342933333333333, 1.9349666666666667),
    ("seasonal_window_average", 5, 1.2475666666666667, 1.2536583333333335),
    ("seasonal_window_average", 5, 0.957, 0.6519541666666666),
    ("seasonal_window_average", 5, 0.2943, 0.5934916666666666),
    ("seasonal_window_average", 5, 0.2809999999999999, 0.4205958333333333),
    ("seasonal_window_average", 5, 0.2734333333333333, 0.4814083333333333),
    ("seasonal_window_average", 5, 0.2983666666666666, 0.47126250000000003),
    ("seasonal_window_average", 5, 0.3140333333333333, 0.3667833333333333),
    ("seasonal_window_average", 5, 0.2825666666666667, 0.4458249999999999),
    ("seasonal_window_average", 5, 1.0087666666666668, 0.9502083333333333),
    ("seasonal_window_average", 5, 2.883933333333333, 2.1641125),
    ("seasonal_window_average", 5, 1.9993, 1.5591666666666666),
    ("seasonal_window_average", 5, 1.8499666666666668, 1.3656416666666666),
    ("seasonal_window_average", 5, 1.352766666666667, 1.2235666666666667),
    ("seasonal_window_average", 5, 1.3389, 1.3064791666666666),
    ("seasonal_window_average", 5, 1.4902000000000002, 1.6672291666666665),
    ("seasonal_window_average", 5, 1.612933333333333, 1.323129166666667),
    ("seasonal_window_average", 5, 1.4077666666666668, 1.2595833333333333),
    ("seasonal_window_average", 5, 0.8764333333333333, 1.1590666666666667),
    ("seasonal_window_average", 5, 1.0679333333333332, 1.015025),
    ("seasonal_window_average", 5, 1.7259, 0.8856791666666667),
    ("seasonal_window_average", 5, 1.5734666666666668, 1.17455),
    ("seasonal_window_average", 5, 1.659333333333333, 1.5983708333333335),
    ("seasonal_window_average", 5, 1.1637, 1.6550041666666666),
    ("seasonal_window_average", 5, 0.9346666666666668, 1.78955),
    ("seasonal_naive_168", 5, 1.2475666666666667, 0.9224333333333334),
    ("seasonal_naive_168", 5, 0.957, 0.4793666666666666),
    ("seasonal_naive_168", 5, 0.2943, 0.3419),
    ("seasonal_naive_168", 5, 0.2809999999999999, 0.2770666666666666),
    ("seasonal_naive_168", 5, 0.2734333333333333, 0.9548666666666666),
    ("seasonal_naive_168", 5, 0.2983666666666666, 0.3147),
    ("seasonal_naive_168", 5, 0.3140333333333333, 0.3387333333333333),
    ("seasonal_naive_168", 5, 0.2825666666666667, 0.2649333333333333),
    ("seasonal_naive_168", 5, 1.0087666666666668, 0.8500666666666666),
    ("seasonal_naive_168", 5, 2.883933333333333, 2.2033),
    ("seasonal_naive_168", 5, 1.9993, 1.4469666666666667),
    ("seasonal_naive_168", 5, 1.8499666666666668, 1.3643666666666665),
    ("seasonal_naive_168", 5, 1.352766666666667, 1.3499),
    ("seasonal_naive_168", 5, 1.3389, 1.3954666666666666),
    ("seasonal_naive_168", 5, 1.4902000000000002, 1.3907),
    ("seasonal_naive_168", 5, 1.612933333333333, 1.5944),
    ("seasonal_naive_168", 5, 1.4077666666666668, 1.5211),
    ("seasonal_naive_168", 5, 0.8764333333333333, 1.622866666666667),
    ("seasonal_naive_168", 5, 1.0679333333333332, 1.4697),
    ("seasonal_naive_168", 5, 1.7259, 0.8242666666666667),
    ("seasonal_naive_168", 5, 1.5734666666666668, 1.0184666666666666),
    ("seasonal_naive_168", 5, 1.659333333333333, 1.2497666666666667),
    ("seasonal_naive_168", 5, 1.1637, 1.665266666666667),
    ("seasonal_naive_168", 5, 0.9346666666666668, 1.7783666666666669),
]

# Machine-learning predictions (y, y_pred), random forest window 1.
RF_WINDOW_1 = [
    (0.8328000000000001, 1.22986026703494),
    (0.5997, 0.6566879801504707),
    (0.3583666666666666, 0.4674783563041356),
    (0.2653, 0.45297230243973363),
    (0.5021, 0.4546092304860087),
    (0.7512333333333333, 0.47466948681943677),
    (0.3203, 0.6128161632593588),
    (0.2844, 0.5012147043981464),
    (0.8289666666666666, 0.9562555472198643),
    (2.8502333333333336, 2.426548381847774),
    (1.5541666666666667, 1.8673347913945018),
    (1.3640333333333332, 1.6299984637181615),
    (1.3725999999999998, 1.6105026255851784),
    (1.3923666666666668, 1.6062449750401855),
    (1.5837666666666663, 1.5923285175563844),
    (1.9610333333333332, 1.4269696914821801),
    (2.0177666666666667, 1.27717297622632),
    (1.502033333333333, 0.920965967251151),
    (0.8740666666666667, 0.8480436298008291),
    (1.9389333333333332, 0.9792495233731493),
    (2.0611333333333333, 1.4267761661045917),
    (1.4982333333333335, 2.2339618755368287),
    (2.3128666666666664, 2.2218183428315106),
    (1.568366666666667, 2.123647395526894),
]

# Machine-learning predictions (y, y_pred), ridge regression window 3.
RIDGE_WINDOW_3 = [
    (1.2475666666666667, 1.0479359535071466),
    (0.957, 0.746341627885928),
    (0.2943, 0.5019006604898689),
    (0.2809999999999999, 0.3443988788668154),
    (0.2734333333333333, 0.37943497229161127),
    (0.2983666666666666, 0.3732397539814767),
    (0.3140333333333333, 0.36730354928805053),
    (0.2825666666666667, 0.4471838370609589),
    (1.0087666666666668, 0.697078521528663),
    (2.883933333333333, 1.4771475678064816),
    (1.9993, 1.5440242473771815),
    (1.8499666666666668, 1.441219003043857),
    (1.352766666666667, 1.3319651281290568),
    (1.3389, 1.3257136259701805),
    (1.4902000000000002, 1.2468859431149044),
    (1.612933333333333, 1.2133708834569747),
    (1.4077666666666668, 1.238877631609965),
    (0.8764333333333333, 1.1514214122280633),
    (1.0679333333333332, 1.0472001853423973),
    (1.7259, 1.0946047907556102),
    (1.5734666666666668, 1.288682125080551),
    (1.659333333333333, 1.4280645040950015),
    (1.1637, 1.574406913119526),
    (0.9346666666666668, 1.4705610987313689),
]

# Published metrics and test statistics.
PIPELINE_SMAPE = {"seasonal_naive_168": 37.64621907220435, "seasonal_window_average": 41.186557503534985}
PIPELINE_MAE = {"seasonal_naive_168": 0.4102147222222222, "seasonal_window_average": 0.4099837193524099}
RF_WINDOW_1_METRICS = (0.33468807926, 0.42029902485, 31.2343607, 29.1446923)        # mae, rmse, mape, smape
RIDGE_WINDOW_3_METRICS = (0.28741552795, 0.40526156522, 26.8717914, 26.0963213)
BIAS_T = (-0.09530770697278386, 0.9242307279829995)
LJUNG_BOX_24 = (67.32721704713528, 5.511880323158505e-06)
PAIRED_T = (-0.006941618621694225, 0.9944730578202086)
ADF = (-10.503511214164622, 1.0688373131265099e-18)
NAIVE_BAND_ROW = (0.9346666666666668, -0.22657254045853636, 2.09590587379187, -0.8434808692438005, 2.712814202577134)
