"""The small published input tables of five domains, and the results expected from them."""

INPUTS = {
    "account": """
account_id,customer_id,balance,status
A1001,C001,86200.50,ACTIVE
A1002,C002,245600.00,ACTIVE
A1003,C003,3200.20,ACTIVE
A1004,C004,12800.00,FROZEN
A1005,C005,560000.00,ACTIVE
A1006,C006,980.00,ACTIVE
A1007,C007,420000.00,ACTIVE
A1008,C008,73500.00,ACTIVE
A1009,C009,15400.00,ACTIVE
A1010,C010,308000.00,ACTIVE
A1011,C011,18600.00,ACTIVE
A1012,C012,99000.00,ACTIVE
""",
    "transaction": """
txn_id,account_id,amount,txn_time,channel,txn_type,txn_status
T0001,A1001,1200.00,2026-06-01 09:12:00,mobile,transfer,SUCCESS
T0002,A1001,86.50,2026-06-02 12:45:00,pos,consume,SUCCESS
T0003,A1002,32000.00,2026-06-02 22:10:00,online,transfer,SUCCESS
T0004,A1002,28000.00,2026-06-03 22:18:00,online,transfer,SUCCESS
T0005,A1003,199.00,2026-06-04 14:02:00,mobile,consume,SUCCESS
T0006,A1003,8500.00,2026-06-05 02:13:00,mobile,transfer,SUCCESS
T0007,A1004,52000.00,2026-06-05 01:35:00,online,transfer,SUCCESS
T0008,A1004,48000.00,2026-06-05 01:42:00,online,transfer,SUCCESS
T0009,A1005,15000.00,2026-06-06 10:30:00,branch,transfer,SUCCESS
T0010,A1005,2300.00,2026-06-07 16:20:00,pos,consume,SUCCESS
T0011,A1006,2600.00,2026-06-08 00:18:00,mobile,transfer,FAILED
T0012,A1006,2700.00,2026-06-08 00:25:00,mobile,transfer,FAILED
T0013,A1007,89000.00,2026-06-08 23:50:00,online,transfer,SUCCESS
T0014,A1007,76000.00,2026-06-09 00:12:00,online,transfer,SUCCESS
T0015,A1008,3600.00,2026-06-09 11:04:00,mobile,repayment,SUCCESS
T0016,A1008,420.00,2026-06-10 19:42:00,pos,consume,SUCCESS
T0017,A1009,9800.00,2026-06-10 03:20:00,online,transfer,SUCCESS
T0018,A1010,5000.00,2026-06-11 09:18:00,branch,withdraw,SUCCESS
T0019,A1011,22000.00,2026-06-11 23:01:00,mobile,transfer,SUCCESS
T0020,A1011,24000.00,2026-06-11 23:08:00,mobile,transfer,SUCCESS
T0021,A1011,26000.00,2026-06-11 23:15:00,mobile,transfer,SUCCESS
T0022,A1012,1800.00,2026-06-12 13:25:00,pos,consume,SUCCESS
T0023,A1012,2200.00,2026-06-13 15:50:00,mobile,transfer,SUCCESS
T0024,A1003,12000.00,2026-06-14 02:40:00,online,transfer,SUCCESS
""",
    "credit": """
credit_id,customer_id,credit_limit,used_credit,snapshot_date
CL001,C001,100000.00,28000.00,2026-06-14
CL002,C002,300000.00,240000.00,2026-06-14
CL003,C003,20000.00,18500.00,2026-06-14
CL004,C004,80000.00,79000.00,2026-06-14
CL005,C005,500000.00,120000.00,2026-06-14
CL006,C006,10000.00,9600.00,2026-06-14
CL007,C007,600000.00,510000.00,2026-06-14
CL008,C008,120000.00,34000.00,2026-06-14
CL009,C009,50000.00,42000.00,2026-06-14
CL010,C010,200000.00,30000.00,2026-06-14
CL011,C011,90000.00,88000.00,2026-06-14
CL012,C012,150000.00,45000.00,2026-06-14
""",
    "overdue": """
overdue_id,customer_id,due_date,overdue_amount,dpd_days,is_current_overdue
OD001,C002,2026-05-20,12000.00,25,1
OD002,C003,2026-04-18,1800.00,8,0
OD003,C004,2026-05-05,9600.00,40,1
OD004,C006,2026-06-01,600.00,13,1
OD005,C007,2026-03-11,22000.00,18,0
OD006,C009,2026-05-28,3500.00,17,1
OD007,C011,2026-06-03,7200.00,11,1
""",
    "vehicle": """
vehicle_id,home_zone,preferred_power_type
V001,Zone_A,DC_FAST
V002,Zone_B,AC_SLOW
V003,Zone_A,DC_FAST
V004,Zone_C,AC_SLOW
V005,Zone_B,DC_FAST
""",
    "station": """
station_id,zone,power_type,available_ports,tariff_cny_per_kwh
S001,Zone_A,DC_FAST,12,1.55
S002,Zone_B,AC_SLOW,20,1.20
S003,Zone_A,AC_SLOW,16,1.10
S004,Zone_C,DC_FAST,10,1.68
S005,Zone_B,DC_FAST,14,1.42
""",
    "charge_order": """
order_id,vehicle_id,station_id,start_time,end_time,energy_kwh,status
O1001,V001,S001,2026-06-01 08:10:00,2026-06-01 08:50:00,28.5,COMPLETED
O1002,V001,S003,2026-06-03 19:00:00,2026-06-03 20:05:00,21.0,COMPLETED
O1003,V002,S002,2026-06-02 09:20:00,2026-06-02 10:40:00,18.3,COMPLETED
O1004,V003,S001,2026-06-03 07:10:00,2026-06-03 07:45:00,25.7,COMPLETED
O1005,V004,S004,2026-06-01 18:15:00,2026-06-01 19:10:00,30.8,COMPLETED
O1006,V005,S005,2026-06-04 12:05:00,2026-06-04 12:55:00,27.4,COMPLETED
O1007,V003,S005,2026-06-05 20:10:00,2026-06-05 20:55:00,24.2,COMPLETED
O1008,V002,S002,2026-06-06 21:00:00,2026-06-06 22:10:00,20.0,COMPLETED
""",
    "charge_payment": """
order_id,amount_cny,is_success
O1001,44.18,1
O1002,23.10,1
O1003,21.96,1
O1004,39.84,1
O1005,51.74,1
O1006,38.91,1
O1007,34.36,1
O1008,24.00,1
""",
    "station_ops": """
station_id,online_rate,queue_minutes,fault_count
S001,0.98,6,0
S002,0.96,12,1
S003,0.99,4,0
S004,0.93,18,2
S005,0.97,8,0
""",
    "behavior": """
user_id,register_time,device_id,ip
U001,2026-06-01 09:10:00,D001,10.0.0.1
U002,2026-06-02 10:20:00,D002,10.0.0.2
U003,2026-06-03 11:15:00,D003,10.0.0.3
U004,2026-06-03 12:18:00,D004,10.0.0.3
U005,2026-06-04 08:00:00,D005,10.0.0.5
U006,2026-06-04 08:12:00,D006,10.0.0.6
U007,2026-06-05 13:22:00,D007,10.0.0.7
U008,2026-06-06 14:10:00,D008,10.0.0.8
U009,2026-06-07 20:30:00,D900,10.0.9.9
U010,2026-06-07 20:35:00,D900,10.0.9.9
U011,2026-06-07 20:40:00,D900,10.0.9.9
U012,2026-06-08 07:50:00,D012,10.0.1.2
""",
    "room": """
room_id,host_id,room_type,start_time,duration_seconds
R01,U003,live,2026-06-21 08:50:00,5400
R02,U003,voice_room,2026-06-21 08:55:00,7200
R03,U005,live,2026-06-21 09:00:00,3600
R04,U008,voice_room,2026-06-21 09:05:00,4200
R09,U009,voice_room,2026-06-21 09:10:00,9000
R12,U012,live,2026-06-21 09:15:00,3000
""",
    "message": """
message_id,user_id,room_id,content,send_time,message_type
M0001,U001,R01,hello everyone,2026-06-21 09:00:00,public_chat
M0002,U002,R01,join my group 8899,2026-06-21 09:02:00,private_message
M0003,U003,R02,welcome to my room,2026-06-21 09:03:00,public_chat
M0004,U004,R02,join my group 8899,2026-06-21 09:05:00,private_message
M0005,U005,R03,big reward click link,2026-06-21 09:08:00,public_chat
M0006,U006,R03,join my group 8899,2026-06-21 09:10:00,private_message
M0007,U007,R04,normal chat today,2026-06-21 09:12:00,voice_transcript
M0008,U008,R04,join my group 8899,2026-06-21 09:13:00,private_message
M0009,U009,R09,join my group 8899,2026-06-21 09:15:00,private_message
M0010,U010,R09,join my group 8899,2026-06-21 09:16:00,private_message
M0011,U011,R09,join my group 8899,2026-06-21 09:17:00,private_message
M0012,U012,R12,thanks for watching,2026-06-21 09:20:00,public_chat
M0013,U009,R09,join my group 8899,2026-06-22 10:01:00,private_message
M0014,U010,R09,join my group 8899,2026-06-22 10:02:00,private_message
M0015,U011,R09,join my group 8899,2026-06-22 10:03:00,private_message
M0016,U002,R01,join my group 8899,2026-06-22 10:04:00,private_message
M0017,U004,R02,join my group 8899,2026-06-22 10:05:00,private_message
M0018,U006,R03,join my group 8899,2026-06-22 10:06:00,private_message
M0019,U001,R01,morning all,2026-06-23 08:11:00,public_chat
M0020,U003,R02,live now,2026-06-23 08:21:00,public_chat
M0021,U005,R03,limited offer now,2026-06-23 08:31:00,public_chat
M0022,U009,R09,join my group 8899,2026-06-23 08:41:00,private_message
M0023,U010,R09,join my group 8899,2026-06-23 08:51:00,private_message
M0024,U011,R09,join my group 8899,2026-06-23 09:01:00,private_message
""",
    "report": """
report_id,target_id,report_time
RP001,U002,2026-06-21 10:00:00
RP002,U004,2026-06-21 10:03:00
RP003,U006,2026-06-21 10:08:00
RP004,U009,2026-06-21 10:20:00
RP005,U010,2026-06-21 10:22:00
RP006,U011,2026-06-21 10:25:00
RP007,U009,2026-06-22 11:30:00
RP008,U010,2026-06-22 11:40:00
RP009,U011,2026-06-22 11:50:00
RP010,U005,2026-06-23 09:15:00
""",
    "review": """
case_id,target_id,review_time,review_result,appeal_result
C001,U002,2026-06-21 11:30:00,violation,not_appealed
C002,U004,2026-06-21 11:35:00,violation,not_appealed
C003,U006,2026-06-21 11:40:00,violation,upheld
C004,U009,2026-06-21 11:50:00,violation,upheld
C005,U010,2026-06-21 11:55:00,violation,upheld
C006,U011,2026-06-21 12:00:00,violation,upheld
C007,U005,2026-06-23 10:20:00,suspicious,overturned
C008,U001,2026-06-23 10:30:00,normal,not_appealed
""",
    "punishment": """
punish_id,user_id,punish_time,risk_type,punish_type,duration_hours
PN001,U002,2026-06-21 12:00:00,inducement,warning,0
PN002,U004,2026-06-21 12:10:00,inducement,mute,24
PN003,U006,2026-06-21 12:15:00,fraud,mute,24
PN004,U009,2026-06-21 12:20:00,inducement,ban,168
PN005,U010,2026-06-21 12:25:00,inducement,ban,168
PN006,U011,2026-06-21 12:30:00,fraud,ban,720
PN007,U009,2026-06-22 13:00:00,fraud,ban,720
PN008,U010,2026-06-22 13:10:00,fraud,mute,72
PN009,U011,2026-06-22 13:20:00,fraud,mute,72
PN010,U005,2026-06-23 11:00:00,scam,warning,0
""",
    "payment": """
order_id,payer_id,receiver_id,amount,order_time,payment_subject,refund_flag
O001,U001,U003,19.90,2026-06-21 09:30:00,PS001,0
O002,U002,U003,99.00,2026-06-21 09:35:00,PS002,1
O003,U004,U003,129.00,2026-06-21 09:40:00,PS002,1
O004,U006,U005,199.00,2026-06-21 09:45:00,PS003,1
O005,U009,U009,299.00,2026-06-21 10:00:00,PS900,1
O006,U010,U009,399.00,2026-06-21 10:05:00,PS900,1
O007,U011,U009,499.00,2026-06-21 10:10:00,PS900,1
O008,U012,U012,9.90,2026-06-21 10:20:00,PS012,0
""",
    "comp_daily": """
dt,patch_version,region,rank_tier,mode,comp_id,comp_name,tier,play_cnt,top4_cnt,win_cnt,avg_rank
2026-06-18,S11.3,CN,Master+,ranked,COMP_NOVA_95,新星95,S,4200,2380,650,3.95
2026-06-18,S11.3,CN,Master+,ranked,COMP_AP_95,AP95,S,3900,2180,590,4.08
2026-06-18,S11.3,CN,Master+,ranked,COMP_XAYAH,霞,A,3500,1920,480,4.22
2026-06-18,S11.3,CN,Master+,ranked,COMP_MECHA,霸天机甲,A,3100,1680,430,4.34
2026-06-18,S11.3,CN,Master+,ranked,COMP_SAMIRA,莎弥拉,B,2700,1410,330,4.55
2026-06-18,S11.3,CN,Master+,ranked,COMP_DARKSTAR,暗星,B,2200,1120,260,4.69
2026-06-19,S11.3,CN,Master+,ranked,COMP_NOVA_95,新星95,S,4400,2470,690,3.91
2026-06-19,S11.3,CN,Master+,ranked,COMP_AP_95,AP95,S,4100,2310,625,4.02
2026-06-19,S11.3,CN,Master+,ranked,COMP_XAYAH,霞,A,3600,1990,510,4.18
2026-06-19,S11.3,CN,Master+,ranked,COMP_MECHA,霸天机甲,A,3150,1700,440,4.32
2026-06-19,S11.3,CN,Master+,ranked,COMP_SAMIRA,莎弥拉,B,2800,1450,345,4.51
2026-06-19,S11.3,CN,Master+,ranked,COMP_DARKSTAR,暗星,B,2300,1180,270,4.65
2026-06-20,S11.3,CN,Master+,ranked,COMP_NOVA_95,新星95,S,4600,2600,720,3.86
2026-06-20,S11.3,CN,Master+,ranked,COMP_AP_95,AP95,S,4300,2390,655,3.98
2026-06-20,S11.3,CN,Master+,ranked,COMP_XAYAH,霞,A,3700,2020,520,4.17
2026-06-20,S11.3,CN,Master+,ranked,COMP_MECHA,霸天机甲,A,3300,1790,465,4.27
2026-06-20,S11.3,CN,Master+,ranked,COMP_SAMIRA,莎弥拉,B,2900,1510,360,4.48
2026-06-20,S11.3,CN,Master+,ranked,COMP_DARKSTAR,暗星,B,2400,1240,290,4.58
2026-06-22,S11.4,CN,Master+,ranked,COMP_NOVA_95,新星95,S,3900,2130,520,4.21
2026-06-22,S11.4,CN,Master+,ranked,COMP_AP_95,AP95,S,4700,2710,760,3.82
2026-06-22,S11.4,CN,Master+,ranked,COMP_XAYAH,霞,S,4300,2530,690,3.88
2026-06-22,S11.4,CN,Master+,ranked,COMP_MECHA,霸天机甲,A,3600,1990,520,4.15
2026-06-22,S11.4,CN,Master+,ranked,COMP_SAMIRA,莎弥拉,A,3200,1840,490,4.05
2026-06-22,S11.4,CN,Master+,ranked,COMP_DARKSTAR,暗星,B,2100,1060,235,4.74
2026-06-23,S11.4,CN,Master+,ranked,COMP_NOVA_95,新星95,S,3700,2020,500,4.25
2026-06-23,S11.4,CN,Master+,ranked,COMP_AP_95,AP95,S,5000,2910,830,3.75
2026-06-23,S11.4,CN,Master+,ranked,COMP_XAYAH,霞,S,4500,2660,735,3.81
2026-06-23,S11.4,CN,Master+,ranked,COMP_MECHA,霸天机甲,A,3800,2130,560,4.08
2026-06-23,S11.4,CN,Master+,ranked,COMP_SAMIRA,莎弥拉,A,3400,1980,535,3.98
2026-06-23,S11.4,CN,Master+,ranked,COMP_DARKSTAR,暗星,B,2000,990,220,4.86
2026-06-24,S11.4,CN,Master+,ranked,COMP_NOVA_95,新星95,A,3500,1880,470,4.36
2026-06-24,S11.4,CN,Master+,ranked,COMP_AP_95,AP95,S,5200,3060,890,3.69
2026-06-24,S11.4,CN,Master+,ranked,COMP_XAYAH,霞,S,4700,2790,780,3.76
2026-06-24,S11.4,CN,Master+,ranked,COMP_MECHA,霸天机甲,A,3900,2190,585,4.04
2026-06-24,S11.4,CN,Master+,ranked,COMP_SAMIRA,莎弥拉,A,3600,2110,580,3.91
2026-06-24,S11.4,CN,Master+,ranked,COMP_DARKSTAR,暗星,C,1900,900,195,5.02
""",
    "migration": """
before_comp_id,before_comp_name,after_comp_id,after_comp_name,player_cnt
COMP_NOVA_95,新星95,COMP_AP_95,AP95,860
COMP_NOVA_95,新星95,COMP_XAYAH,霞,620
COMP_NOVA_95,新星95,COMP_NOVA_95,新星95,510
COMP_DARKSTAR,暗星,COMP_SAMIRA,莎弥拉,390
COMP_DARKSTAR,暗星,COMP_MECHA,霸天机甲,310
COMP_MECHA,霸天机甲,COMP_MECHA,霸天机甲,520
COMP_XAYAH,霞,COMP_XAYAH,霞,780
COMP_AP_95,AP95,COMP_AP_95,AP95,910
COMP_SAMIRA,莎弥拉,COMP_SAMIRA,莎弥拉,460
COMP_SAMIRA,莎弥拉,COMP_XAYAH,霞,280
""",
    "unit_item": """
patch_version,unit_id,unit_name,cost,item_combo,appear_cnt,top4_rate,win_rate,avg_rank
S11.4,U_AP_CARRY,法系主C,4,蓝霸符+法爆+科技枪,4200,0.612,0.174,3.71
S11.4,U_XAYAH,霞,4,羊刀+无尽+轻语,3900,0.594,0.166,3.83
S11.4,U_MECHA_TANK,机甲前排,4,狂徒+反甲+龙牙,3500,0.561,0.148,4.06
S11.4,U_SAMIRA,莎弥拉,3,无尽+正义+巨杀,3100,0.586,0.161,3.94
S11.4,U_NOVA_5C,新星五费,5,青龙刀+帽子+大天使,2800,0.537,0.134,4.28
S11.4,U_DARKSTAR,暗星核心,4,饮血+泰坦+夜刃,1800,0.474,0.103,5.08
""",
    "order_raw": """
order_id,order_date,shop,province,amount,freight,status
YW20250101001,2025/1/1,淘宝店A,浙江,"¥1,200",¥10,已付款
YW20250101002,2025-01-01,拼多多店B,浙冮,¥350.5,¥8,已付款
YW20250101003,20250102,抖音店C,广东,¥89,¥6,已退款
YW20250101004,2025/1/2,淘宝店A,廣东,"¥2,000",¥15,已付款
YW20250101005,2025-01-02,拼多多店B,江苏,¥580,¥12,已取消
YW20250101006,20250103,抖音店C,浙江,¥260,¥8,已付款
YW20250101007,2025/1/3,淘宝店A,上海,¥180,¥6,已付款
YW20250101008,2025-01-03,拼多多店B,浙江,¥420,¥10,已付款
YW20250101008,2025-01-03,拼多多店B,浙江,¥420,¥10,已付款
YW20250101009,20250104,抖音店C,广东,¥150,¥6,已付款
YW20250101010,2025/1/4,淘宝店A,浙冮,¥980,¥20,已付款
,,,,,,
YW20250101011,2025-01-05,拼多多店B,浙江 , ¥75 , ¥5 ,已退款
YW20250101012,20250105,抖音店C,廣东,¥310,¥8,已付款
""",
    "pay_raw": """
order_id,pay_date,received,fee,channel
YW20250101001,2025-01-01,"¥1,190",¥20,支付宝
YW20250101002,2025/1/1,¥340.5,¥18,微信
YW20250101003,20250102,¥95,¥3,支付宝
YW20250101004,2025-01-02,"¥1,990",¥25,银行卡
YW20250101006,2025-01-03,¥250,¥18,微信
YW20250101007,2025-01-03,¥180,¥6,支付宝
YW20250101008,2025-01-03,¥415,¥15,微信
YW20250101009,2025-01-04,¥148,¥8,支付宝
YW20250101010,2025-01-04,¥950,¥30,银行卡
YW20250101011,2025-01-05,¥80,¥2,支付宝
YW20250101012,2025-01-05,¥315,¥3,微信
""",
    "refund_raw": """
order_id,refund_date,refund
YW20250101003,2025-01-03,¥50
YW20250101011,2025-01-06,¥75
YW20250101005,2025-01-03,¥0
""",
}

EXPECTED = {
    "customer_risk_score": """
customer_id,credit_utilization_rate,overdue_cnt_12m,max_dpd_days_12m,current_overdue_amount,night_txn_cnt_30d,failed_txn_cnt_30d,risk_score,risk_level
C004,0.9875,1,40,9600.0,2.0,0.0,77.56,high
C006,0.96,1,13,600.0,2.0,2.0,59.1,medium
C002,0.8,1,25,12000.0,0.0,0.0,48.83,medium
C007,0.85,1,18,0.0,1.0,0.0,48.75,medium
C009,0.84,1,17,3500.0,1.0,0.0,47.57,medium
C003,0.925,1,8,0.0,2.0,0.0,47.04,medium
C011,0.9778,1,11,7200.0,0.0,0.0,43.39,medium
C012,0.3,0,0,0.0,0.0,0.0,10.5,low
C008,0.2833,0,0,0.0,0.0,0.0,9.92,low
C001,0.28,0,0,0.0,0.0,0.0,9.8,low
C005,0.24,0,0,0.0,0.0,0.0,8.4,low
C010,0.15,0,0,0.0,0.0,0.0,5.25,low
""",
    "customer_segment": """
customer_id,txn_cnt_30d,txn_amount_30d,days_since_last_txn,balance,value_score,active_score,risk_score,risk_level,customer_segment
C001,2,1286.5,12,86200.5,2.57,10.0,9.8,low,general_customer
C002,2,60000.0,11,245600.0,100.0,10.0,48.83,medium,general_customer
C003,3,20699.0,0,3200.2,41.4,15.0,47.04,medium,general_customer
C004,2,100000.0,9,12800.0,100.0,10.0,77.56,high,high_value_high_risk
C005,2,17300.0,7,560000.0,34.6,10.0,8.4,low,general_customer
C006,2,5300.0,6,980.0,10.6,10.0,59.1,medium,general_customer
C007,2,165000.0,5,420000.0,100.0,10.0,48.75,medium,general_customer
C008,2,4020.0,4,73500.0,8.04,10.0,9.92,low,general_customer
C009,1,9800.0,4,15400.0,19.6,5.0,47.57,medium,general_customer
C010,1,5000.0,3,308000.0,10.0,5.0,5.25,low,general_customer
C011,3,72000.0,3,18600.0,100.0,15.0,43.39,medium,general_customer
C012,2,4000.0,1,99000.0,8.0,10.0,10.5,low,general_customer
""",
    "abnormal_transactions": """
txn_id,customer_id,account_id,amount,txn_time,channel,txn_type,txn_status,abnormal_reason,severity
T0024,C003,A1003,12000.0,2026-06-14 02:40:00,online,transfer,SUCCESS,unusual_channel,low
T0021,C011,A1011,26000.0,2026-06-11 23:15:00,mobile,transfer,SUCCESS,high_frequency,medium
T0020,C011,A1011,24000.0,2026-06-11 23:08:00,mobile,transfer,SUCCESS,high_frequency,medium
T0019,C011,A1011,22000.0,2026-06-11 23:01:00,mobile,transfer,SUCCESS,high_frequency,medium
T0012,C006,A1006,2700.0,2026-06-08 00:25:00,mobile,transfer,FAILED,failed_large_txn,low
""",
    "reco_topn": """
vehicle_id,station_id,recommend_score,rank_no
V001,S001,0.6567,1
V001,S003,0.5308,2
V001,S005,0.3214,3
V002,S002,0.7423,1
V002,S005,0.4214,2
V002,S003,0.3433,3
V003,S001,0.6567,1
V003,S003,0.4433,2
V003,S005,0.4089,3
V004,S004,0.4644,1
V004,S003,0.3433,2
V004,S002,0.3173,3
V005,S005,0.6589,1
V005,S002,0.4173,2
V005,S001,0.3192,3
""",
    "suspect_clusters": """
cluster_type,cluster_key,user_cnt,report_cnt,punish_cnt,punished_user_cnt,punish_user_rate
payment_subject,PS900,3,6,6,3,1.0
ip,10.0.0.3,2,1,1,1,0.5
device,D900,3,6,6,3,1.0
payment_subject,PS003,2,2,2,2,1.0
payment_subject,PS002,3,2,2,2,0.6667
ip,10.0.9.9,3,6,6,3,1.0
""",
    "room_risk_features": """
room_id,host_id,room_type,duration_seconds,message_cnt,private_message_cnt,report_cnt,punished_user_cnt,minutes_to_first_punished_message
R09,U009,voice_room,9000,9,9,6,3,5
R04,U008,voice_room,4200,2,1,0,0,
R03,U005,live,3600,4,2,2,2,8
R12,U012,live,3000,1,0,0,0,
R01,U003,live,5400,4,2,1,1,12
R02,U003,voice_room,7200,4,2,1,1,10
""",
    "account_risk_features": """
user_id,account_age_hours,message_cnt_all,private_message_cnt,report_cnt_all,punish_cnt_all,device_user_cnt,ip_user_cnt,payment_order_cnt,payment_amount_sum
U002,557,2,2,1,1,1,1,1,99.0
U004,531,2,2,1,1,1,2,1,129.0
U005,511,2,0,1,1,1,1,1,199.0
U006,511,2,2,1,1,1,1,1,199.0
U009,427,3,3,2,2,3,3,3,1197.0
U010,427,3,3,2,2,3,3,1,399.0
U011,427,3,3,2,2,3,3,1,499.0
U001,582,2,0,0,0,1,1,1,19.9
U003,532,2,0,0,0,1,2,3,247.9
U012,416,1,0,0,0,1,1,1,9.9
U007,482,1,0,0,0,1,1,0,0.0
U008,457,1,1,0,0,1,1,0,0.0
""",
    "risk_event_ranking": """
case_id,target_id,risk_level,risk_score,review_result,appeal_result,root_cause,report_cnt_all,private_message_cnt,device_user_cnt,payment_amount_sum
C004,U009,high,76.25,violation,upheld,cluster_abuse,2,3,3,1197.0
C006,U011,high,75.0,violation,upheld,cluster_abuse,2,3,3,499.0
C005,U010,high,73.75,violation,upheld,cluster_abuse,2,3,3,399.0
C003,U006,medium,38.75,violation,upheld,single_case_review,1,2,1,199.0
C002,U004,medium,36.88,violation,not_appealed,single_case_review,1,2,1,129.0
C001,U002,medium,35.62,violation,not_appealed,single_case_review,1,2,1,99.0
C007,U005,low,15.62,suspicious,overturned,possible_false_positive,1,0,1,199.0
C008,U001,low,8.12,normal,not_appealed,single_case_review,0,0,1,19.9
""",
    "patch_delta": """
comp_id,comp_name,play_cnt_before,top4_cnt_before,win_cnt_before,avg_rank_before,top4_rate_before,win_rate_before,play_cnt_after,top4_cnt_after,win_cnt_after,avg_rank_after,top4_rate_after,win_rate_after,play_delta,top4_delta,win_delta,avg_rank_delta,patch_reading
COMP_SAMIRA,莎弥拉,8400,4370,1035,4.513333333333333,0.5202380952380953,0.12321428571428572,10200,5930,1605,3.98,0.5813725490196079,0.15735294117647058,1800,0.06113445378151261,0.034138655462184864,-0.5333333333333328,meta_rising
COMP_XAYAH,霞,10800,5930,1510,4.19,0.549074074074074,0.1398148148148148,13500,7980,2205,3.8166666666666664,0.5911111111111111,0.16333333333333333,2700,0.042037037037037095,0.023518518518518522,-0.37333333333333396,buff_effective
COMP_AP_95,AP95,12300,6880,1870,4.026666666666666,0.5593495934959349,0.15203252032520326,14900,8680,2480,3.7533333333333334,0.5825503355704698,0.16644295302013423,2600,0.02320074207453482,0.014410432694930975,-0.273333333333333,watch
COMP_MECHA,霸天机甲,9550,5170,1335,4.31,0.5413612565445026,0.13979057591623037,11300,6310,1665,4.09,0.5584070796460177,0.14734513274336283,1750,0.017045823101515034,0.007554556827132464,-0.21999999999999975,watch
COMP_NOVA_95,新星95,13200,7450,2060,3.9066666666666667,0.5643939393939394,0.15606060606060607,11100,6030,1490,4.273333333333333,0.5432432432432432,0.13423423423423422,-2100,-0.021150696150696202,-0.021826371826371843,0.3666666666666667,watch
COMP_DARKSTAR,暗星,6900,3540,820,4.640000000000001,0.5130434782608696,0.11884057971014493,6000,2950,650,4.873333333333334,0.49166666666666664,0.10833333333333334,-900,-0.02137681159420296,-0.010507246376811594,0.2333333333333334,watch
""",
    "comp_meta": """
dt,patch_version,region,rank_tier,comp_id,comp_name,tier,play_cnt,pick_rate,top4_rate,win_rate,top4_share,win_share,avg_rank,meta_flag
2026-06-24,S11.4,CN,Master+,COMP_AP_95,AP95,S,5200,0.22807017543859648,0.5884615384615385,0.17115384615384616,0.23665893271461716,0.2542857142857143,3.69,overpowered
2026-06-24,S11.4,CN,Master+,COMP_XAYAH,霞,S,4700,0.20614035087719298,0.5936170212765958,0.16595744680851063,0.21577726218097448,0.22285714285714286,3.76,overpowered
2026-06-24,S11.4,CN,Master+,COMP_MECHA,霸天机甲,A,3900,0.17105263157894737,0.5615384615384615,0.15,0.16937354988399073,0.16714285714285715,4.04,normal
2026-06-24,S11.4,CN,Master+,COMP_SAMIRA,莎弥拉,A,3600,0.15789473684210525,0.5861111111111111,0.16111111111111112,0.16318638824439288,0.1657142857142857,3.91,normal
2026-06-24,S11.4,CN,Master+,COMP_NOVA_95,新星95,A,3500,0.15350877192982457,0.5371428571428571,0.13428571428571429,0.1453982985305491,0.13428571428571429,4.36,normal
2026-06-24,S11.4,CN,Master+,COMP_DARKSTAR,暗星,C,1900,0.08333333333333333,0.47368421052631576,0.10263157894736842,0.06960556844547564,0.055714285714285716,5.02,normal
""",
    "migration_share": """
before_comp_id,before_comp_name,after_comp_id,after_comp_name,player_cnt,migration_share
COMP_AP_95,AP95,COMP_AP_95,AP95,910,0.16134751773049646
COMP_NOVA_95,新星95,COMP_AP_95,AP95,860,0.1524822695035461
COMP_XAYAH,霞,COMP_XAYAH,霞,780,0.13829787234042554
COMP_NOVA_95,新星95,COMP_XAYAH,霞,620,0.1099290780141844
COMP_MECHA,霸天机甲,COMP_MECHA,霸天机甲,520,0.09219858156028368
COMP_NOVA_95,新星95,COMP_NOVA_95,新星95,510,0.09042553191489362
COMP_SAMIRA,莎弥拉,COMP_SAMIRA,莎弥拉,460,0.08156028368794327
COMP_DARKSTAR,暗星,COMP_SAMIRA,莎弥拉,390,0.06914893617021277
COMP_DARKSTAR,暗星,COMP_MECHA,霸天机甲,310,0.0549645390070922
COMP_SAMIRA,莎弥拉,COMP_XAYAH,霞,280,0.04964539007092199
""",
    "unit_item_risk": """
patch_version,unit_id,unit_name,cost,item_combo,appear_cnt,top4_rate,win_rate,avg_rank,balance_flag
S11.4,U_AP_CARRY,法系主C,4,蓝霸符+法爆+科技枪,4200,0.612,0.174,3.71,overpowered_item_binding
S11.4,U_XAYAH,霞,4,羊刀+无尽+轻语,3900,0.594,0.166,3.83,overpowered_item_binding
S11.4,U_SAMIRA,莎弥拉,3,无尽+正义+巨杀,3100,0.586,0.161,3.94,normal
S11.4,U_MECHA_TANK,机甲前排,4,狂徒+反甲+龙牙,3500,0.561,0.148,4.06,normal
S11.4,U_NOVA_5C,新星五费,5,青龙刀+帽子+大天使,2800,0.537,0.134,4.28,normal
S11.4,U_DARKSTAR,暗星核心,4,饮血+泰坦+夜刃,1800,0.474,0.103,5.08,underpowered_core
""",
    "clean_orders": """
order_id,order_date,shop,province,amount,freight,status,received,fee,channel,refund,receivable,difference,reason
YW20250101001,2025-01-01,淘宝店A,浙江,1200.0,10.0,已付款,1190.0,20.0,支付宝,0.0,1190.0,0.0,正常
YW20250101002,2025-01-01,拼多多店B,浙江,350.5,8.0,已付款,340.5,18.0,微信,0.0,340.5,0.0,正常
YW20250101003,2025-01-02,抖音店C,广东,89.0,6.0,已退款,95.0,3.0,支付宝,50.0,42.0,-53.0,金额不一致
YW20250101004,2025-01-02,淘宝店A,广东,2000.0,15.0,已付款,1990.0,25.0,银行卡,0.0,1990.0,0.0,正常
YW20250101005,2025-01-02,拼多多店B,江苏,580.0,12.0,已取消,0.0,0.0,,0.0,592.0,592.0,金额不一致
YW20250101006,2025-01-03,抖音店C,浙江,260.0,8.0,已付款,250.0,18.0,微信,0.0,250.0,0.0,正常
YW20250101007,2025-01-03,淘宝店A,上海,180.0,6.0,已付款,180.0,6.0,支付宝,0.0,180.0,0.0,正常
YW20250101008,2025-01-03,拼多多店B,浙江,420.0,10.0,已付款,415.0,15.0,微信,0.0,415.0,0.0,正常
YW20250101009,2025-01-04,抖音店C,广东,150.0,6.0,已付款,148.0,8.0,支付宝,0.0,148.0,0.0,正常
YW20250101010,2025-01-04,淘宝店A,浙江,980.0,20.0,已付款,950.0,30.0,银行卡,0.0,970.0,20.0,金额不一致
YW20250101011,2025-01-05,拼多多店B,浙江,75.0,5.0,已退款,80.0,2.0,支付宝,75.0,3.0,-77.0,金额不一致
YW20250101012,2025-01-05,抖音店C,广东,310.0,8.0,已付款,315.0,3.0,微信,0.0,315.0,0.0,正常
""",
    "daily_finance": """
order_date,shop,gmv,order_cnt,refund,fee,received,net_income
2025-01-01,淘宝店A,1200.0,1,0.0,20.0,1190.0,1170.0
2025-01-01,拼多多店B,350.5,1,0.0,18.0,340.5,322.5
2025-01-02,抖音店C,89.0,1,50.0,3.0,95.0,42.0
2025-01-02,淘宝店A,2000.0,1,0.0,25.0,1990.0,1965.0
2025-01-02,拼多多店B,580.0,1,0.0,0.0,0.0,0.0
2025-01-03,抖音店C,260.0,1,0.0,18.0,250.0,232.0
2025-01-03,淘宝店A,180.0,1,0.0,6.0,180.0,174.0
2025-01-03,拼多多店B,420.0,1,0.0,15.0,415.0,400.0
2025-01-04,抖音店C,150.0,1,0.0,8.0,148.0,140.0
2025-01-04,淘宝店A,980.0,1,0.0,30.0,950.0,920.0
2025-01-05,拼多多店B,75.0,1,75.0,2.0,80.0,3.0
2025-01-05,抖音店C,310.0,1,0.0,3.0,315.0,312.0
""",
    "alerts": """
order_id,order_date,shop,province,amount,freight,status,received,fee,channel,refund,receivable,difference,reason
YW20250101003,2025-01-02,抖音店C,广东,89.0,6.0,已退款,95.0,3.0,支付宝,50.0,42.0,-53.0,金额不一致
YW20250101005,2025-01-02,拼多多店B,江苏,580.0,12.0,已取消,0.0,0.0,,0.0,592.0,592.0,金额不一致
YW20250101010,2025-01-04,淘宝店A,浙江,980.0,20.0,已付款,950.0,30.0,银行卡,0.0,970.0,20.0,金额不一致
YW20250101011,2025-01-05,拼多多店B,浙江,75.0,5.0,已退款,80.0,2.0,支付宝,75.0,3.0,-77.0,金额不一致
""",
}
