"""Expected results the operators have to reproduce, as plain text tables."""

# month label; sales; centred three-month mean; sales growth in percent (label order)
MONTHLY = """
Apr-2014;12455.482;;
Apr-2015;11963.696;15571.857333333333;-3.948349810950713
Apr-2016;22296.394;18568.95233333333;86.36710595120438
Apr-2017;21446.767;23513.641333333333;-3.8106027369268825
Aug-2014;26797.763;24014.90166666667;24.950128846925978
Aug-2015;23800.175;24918.086866666665;-11.185963544792898
Aug-2016;24156.3226;24926.7292;1.496407484398743
Aug-2017;26823.69;22835.099099999996;11.042108702423103
Dec-2014;17525.2847;18086.055233333333;-34.66489994478761
Dec-2015;9909.191;16302.231399999999;-43.45774593892903
Dec-2016;21472.2185;16012.803833333333;116.68992453571639
Dec-2017;16657.002;16654.2795;-22.42533299481839
Feb-2014;11833.618;13836.311666666666;-28.95709564062008
Feb-2015;13018.315;22716.889333333336;10.011283108851421
Feb-2016;43298.735;31101.835333333333;232.59861203235596
Feb-2017;36988.456;33309.206;-14.573818380606273
Jan-2014;19640.427;24776.856466666664;-46.90119803865292
Jan-2015;17701.686400000002;21211.8448;-9.871173371128828
Jan-2016;26293.421000000002;25278.339799999998;48.53624906607767
Jan-2017;31839.912;22785.253666666667;21.09459624900083
Jul-2014;10222.428;17589.686666666665;-67.89429568775189
Jul-2015;10706.72;12500.142333333331;4.737543761619056
Jul-2016;16571.279;17462.826166666666;54.77456214414871
Jul-2017;25110.4795;17869.869166666664;51.53012329344045
Jun-2014;11927.849;16716.992233333334;-52.49852158338912
Jun-2015;13112.6482;13552.634066666666;9.93304995728903
Jun-2016;15617.404999999999;13793.002999999997;19.101837872840967
Jun-2017;12648.9558;11808.67693333333;-19.007313955167326
Mar-2014;7159.67;10672.010799999998;-43.39714587349574
Mar-2015;12207.4066;15140.150533333332;70.50236393576799
Mar-2016;26053.375;21685.972866666663;113.42268553584512
Mar-2017;26797.137;22710.307666666664;2.8547625787445963
May-2014;15280.411;17520.34333333333;-42.97744941931669
May-2015;10483.482;16180.450599999996;-31.39267000082655
May-2016;22777.4588;16413.36593333333;117.26997575805443
May-2017;15979.157;19182.933266666663;-29.84662099355878
Nov-2014;18792.184;15636.7935;17.604351718929866
Nov-2015;12139.0395;17136.343833333332;-35.40378542483407
Nov-2016;20477.808;16941.01583333333;68.69380810565777
Nov-2017;18206.2;16265.549666666664;-11.093023237643408
Oct-2014;10112.641;13668.354999999996;-44.454960398106145
Oct-2015;12686.224;15145.172999999995;25.449168026433465
Oct-2016;22636.654000000002;17627.066666666662;78.43492279499402
Oct-2017;17558.322;19117.96933333333;-22.434110624299876
Sep-2014;17158.932;17067.385;-2.274647884917469
Sep-2015;16484.901;14477.831666666665;-3.928164060560402
Sep-2016;9789.662;16293.017666666665;-40.614371903113046
Sep-2017;22604.49;;130.90163889212926
"""

# month label; deviation from the centred mean in percent (label order)
ANOMALIES = """
Apr-2015;23.1710402689707
Apr-2016;20.073516263895502
Aug-2017;17.466930546406097
Dec-2015;39.215738282306546
Dec-2016;34.09405825169718
Feb-2015;42.69323229524324
Feb-2016;39.21601261130292
Jan-2014;20.73075522545371
Jan-2015;16.5481052359953
Jan-2017;39.7391157710906
Jul-2014;41.88396761283979
Jul-2017;40.51854138271767
Jun-2014;28.64835471888228
Mar-2014;32.91170582398585
Mar-2015;19.370639194613368
Mar-2016;20.139295387786987
Mar-2017;17.995482022164893
May-2015;35.208961362299746
May-2016;38.77384378387651
May-2017;16.70118027378912
Nov-2014;20.17926821122247
Nov-2015;29.162021852133112
Nov-2016;20.87709616390086
Oct-2014;26.01420580603882
Oct-2015;16.235859438515465
Oct-2016;28.419858097017514
Sep-2016;39.9149856688099
"""

# date; revenue; units; revenue growth; units growth; trailing means; anomaly mark
TREND_REPORT = """
2023-01-01;3638180.33;8607;;;3638180.33;8607.0;False
2023-02-01;3231749.9899999998;8890;-11.171253295187821;3.2880213779481915;3434965.16;8748.5;False
2023-03-01;3122037.55;11253;-3.394830675005278;26.58042744656919;3330655.9566666665;9583.333333333334;False
2023-04-01;3346451.48;13187;7.188059925800716;17.186528036967918;3233413.0066666664;11110.0;False
2023-05-01;5108735.15;15709;52.661264642032116;19.12489573064382;3859074.7266666666;13383.0;True
2023-06-01;4566770.17;15841;-10.608594184022246;0.8402826405245367;4340652.266666667;14912.333333333334;False
2023-07-01;6034025.4;15512;32.128948367900904;-2.0768890852850164;5236510.24;15687.333333333334;True
2023-08-01;2782524.23;13721;-53.886103462540945;-11.54589994842703;4461106.600000001;15024.666666666666;True
2023-09-01;4005085.57;11839;43.93713186102246;-13.716201443043508;4273878.399999999;13690.666666666666;False
2023-10-01;3443515.32;9643;-14.021429509682115;-18.54886392431794;3410375.0399999996;11734.333333333334;False
2023-11-01;3829910.43;7964;11.220949352419328;-17.41159390231256;3759503.7733333334;9815.333333333334;False
2023-12-01;2900619.2800000003;6671;-24.264043950500426;-16.23556002009041;3391348.3433333337;8092.666666666667;False
2024-01-01;1693219.19;7366;-41.62559693114913;10.418228151701392;2807916.3000000003;7333.666666666667;True
2024-02-01;3230247.95;9434;90.7755339106451;28.074938908498503;2608028.8066666666;7823.666666666667;True
2024-03-01;4300089.46;10123;33.11948576579083;7.303370786516861;3074518.866666667;8974.333333333334;True
2024-04-01;3778886.88;12918;-12.12073806483087;27.610392176232335;3769741.43;10825.0;False
2024-05-01;6566185.06;16286;73.75976758531601;26.072147391237046;4881720.466666666;13109.0;True
2024-06-01;7721940.03;15179;17.60162041488367;-6.797249171067177;6022337.323333333;14794.333333333334;True
2024-07-01;6066638.3;14019;-21.43634531696823;-7.64213716318598;6784921.13;15161.333333333334;False
2024-08-01;4693789.22;12698;-22.62948625105934;-9.422926028960699;6160789.183333334;13965.333333333334;True
2024-09-01;3823423.09;11749;-18.542931716903976;-7.473617892581508;4861283.536666666;12822.0;True
2024-10-01;4675801.47;9201;22.29359293846813;-21.686952081028178;4397671.260000001;11216.0;False
2024-11-01;2845360.85;8522;-39.147098775346414;-7.379632648625146;3781528.4700000007;9824.0;True
2024-12-01;1951933.01;7132;-31.39945641692512;-16.31072518188219;3157698.4433333334;8285.0;True
"""

# sub-category; profit; sales; margin, best first
SUBCATEGORIES = """
Labels;2571.7938;5770.804;44.57
Paper;13174.6211;30294.068;43.49
Envelopes;2494.9859;5972.36;41.78
Copiers;22444.6833;58539.082;38.34
Fasteners;328.0706;1259.172;26.05
Accessories;17797.6428;70981.246;25.07
Art;2930.7657;12730.606;23.02
Phones;16345.1075;125326.604;13.04
Appliances;4187.9196;38574.487;10.86
Furnishings;3707.2282;34617.076;10.71
Storage;8961.9798;84906.302;10.56
Chairs;12106.2254;124914.961;9.69
Machines;6722.9160999999995;83658.196;8.04
Binders;2649.4397;66415.346;3.99
Bookcases;-1322.9912;41278.8721;-3.21
Tables;-5545.5319;88925.3715;-6.24
Supplies;-946.5691;13056.922;-7.25
"""

# product; profit; sales; quantity; margin; ranking
PRODUCTS = """
Adams Telephone Message Book w/Frequently-Called Numbers Space, 400 Messages per Book;63.84;127.68;16;50.0;Top 10
Avery 475;88.8;177.6;12;50.0;Top 10
Brown Kraft Recycled Envelopes;59.43;118.86;7;50.0;Top 10
Canon imageCLASS MF7460 Monochrome Digital Laser Multifunction Copier;1995.99;3991.98;2;50.0;Top 10
Peel & Seel Recycled Catalog Envelopes, Brown;11.58;23.16;2;50.0;Top 10
Prang Dustless Chalk Sticks;15.959999999999999;31.919999999999998;19;50.0;Top 10
Southworth Structures Collection;10.92;21.84;3;50.0;Top 10
Xerox 1890;73.41;146.82;3;50.0;Top 10
Xerox 1942;195.76;391.52;8;50.0;Top 10
Ativa V4110MDD Micro-Cut Shredder;2400.9657;4899.93;7;49.0;Top 10
Eureka Disposable Bags for Sanitaire Vibra Groomer I Upright Vac;-4.466;1.624;2;-275.0;Bottom 10
Hoover Commercial Lightweight Upright Vacuum;-3.7584;1.392;2;-270.0;Bottom 10
Tripp Lite Isotel 8 Ultra 8 Outlet Metal Surge;-191.619;70.97;5;-270.0;Bottom 10
Tripp Lite TLP810NET Broadband Surge for Modem/Fax;-53.0088;20.388;2;-260.0;Bottom 10
Acco 6 Outlet Guardian Premium Plus Surge Suppressor;-56.0592;21.984;6;-255.0;Bottom 10
APC 7 Outlet Network SurgeArrest Surge Protector;-241.44;96.576;6;-250.0;Bottom 10
Bush Westfield Collection Bookcases, Dark Cherry Finish, Fully Assembled;-190.8522;90.882;3;-210.0;Bottom 10
Avery Flip-Chart Easel Binder, Black;-14.7708;8.952;2;-165.0;Bottom 10
GBC Standard Plastic Binding Systems Combs;-5.487;3.54;2;-155.0;Bottom 10
Ibico EPK-21 Electric Binding System;-2929.4845;1889.99;5;-155.0;Bottom 10
"""

# month label; profit; sales; margin in percent
MARGINS = """
Apr-2015;108083.679956629;912004.400261305;11.85
Apr-2016;114976.619906938;900492.919909295;12.77
Apr-2017;115961.06019266699;932318.20057466;12.44
Aug-2015;117979.770301531;925192.870535762;12.75
Aug-2016;110729.540117032;942408.940467754;11.75
Aug-2017;131501.160211149;996507.88074761;13.2
Dec-2015;110641.549880989;950526.920552301;11.64
Dec-2016;105002.68993700799;932112.890084133;11.27
Dec-2017;65837.629744941;452741.530874991;14.54
Feb-2015;99140.660195881;833012.429253123;11.9
Feb-2016;86809.490641663;870116.749786724;9.98
Feb-2017;115111.070097214;891924.289692601;12.91
Jan-2015;111660.740131745;945382.1605344249;11.81
Jan-2016;106780.950228697;940283.630375412;11.36
Jan-2017;114843.850276999;925472.619840525;12.41
Jan-2018;33841.889977086;297952.050994565;11.36
Jul-2015;115624.059878668;932936.790226654;12.39
Jul-2016;119941.720183092;939216.40059965;12.77
Jul-2017;113026.700038081;992423.43050275;11.39
Jun-2015;110147.160313142;920242.060275583;11.97
Jun-2016;104196.070108119;901448.010186072;11.56
Jun-2017;110399.290304686;927445.97016683;11.9
Mar-2015;113778.210191127;944050.110472353;12.05
Mar-2016;101259.99024981;921487.730559933;10.99
Mar-2017;118688.90021145;942290.430651583;12.6
May-2015;112147.900143277;943939.76995613;11.88
May-2016;110716.120111335;924978.220743864;11.97
May-2017;115014.64001427;993199.05077958;11.58
Nov-2015;104427.360119529;924602.570546607;11.29
Nov-2016;109539.199962309;941197.3609678299;11.64
Nov-2017;67791.250204682;563393.47010096;12.03
Oct-2015;101757.87003983899;943131.10021303;10.79
Oct-2016;116781.970048187;941882.280194664;12.4
Oct-2017;113447.169882532;966081.409769428;11.74
Sep-2015;113467.940118142;914522.370143404;12.41
Sep-2016;123384.709977059;900371.629961594;13.7
Sep-2017;122462.390152852;1027111.72871293;11.92
"""

# department; KPI; target; actual values of the twelve months of 2024
METRICS = """
Logistics;on_time_delivery_pct;95.0;101.78 79.88 101.18 102.38 112.99 108.15 114.29 148.37 114.64 111.45 118.72 119.45
Logistics;shipment_delay_days;1.5;1.55 1.43 1.36 1.54 1.3 1.44 1.4 1.34 1.32 1.29 1.25 1.28
Logistics;freight_cost_per_unit;8.0;7.51 9.37 9.18 8.39 9.31 12.4 8.93 9.36 11.32 10.04 9.82 10.85
Logistics;orders_processed;5000.0;3796.13 4705.59 5116.24 5608.95 5820.88 5565.77 4092.15 5643.66 5821.53 6774.4 6712.57 5078.51
Sales;revenue;500000.0;416689.52 528544.31 464411.25 525696.23 569366.24 734522.86 613079.1 659824.8 707201.21 622846.76 651979.78 560424.38
Sales;conversion_rate;12.0;9.65 15.9 11.73 13.67 13.31 14.08 14.89 10.86 15.03 16.38 21.32 19.9
Sales;new_customers;200.0;185.27 186.46 212.22 207.24 170.53 190.37 244.27 216.48 244.69 216.55 234.27 232.53
Sales;avg_deal_size;2500.0;2800.87 2419.26 2279.05 2570.73 2443.69 2489.65 2432.69 2045.16 2241.98 2222.03 2521.33 2352.95
Operations;process_efficiency_pct;90.0;87.29 97.66 95.14 97.78 81.35 106.79 130.05 105.41 103.58 94.76 116.68 123.95
Operations;error_rate_pct;2.0;1.89 2.31 1.75 2.65 2.02 3.78 2.31 2.82 2.46 2.67 3.34 2.65
Operations;sla_compliance_pct;98.0;108.65 100.05 94.71 96.39 121.0 106.31 80.1 69.59 75.94 64.84 86.32 74.93
Operations;downtime_hours;5.0;4.94 5.19 3.62 5.39 5.14 5.66 4.62 5.45 5.1 6.63 6.99 6.29
"""
