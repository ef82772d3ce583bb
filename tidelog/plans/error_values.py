"""Rows of the error table as the oracle of ``error_enrich`` knows them: a copy of its own."""

ERRORS = """
1000 ER_HASHCHK HY000
1001 ER_NISAMCHK HY000
1002 ER_NO HY000
1003 ER_YES HY000
1004 ER_CANT_CREATE_FILE HY000
1005 ER_CANT_CREATE_TABLE HY000
1006 ER_CANT_CREATE_DB HY000
1007 ER_DB_CREATE_EXISTS HY000
1008 ER_DB_DROP_EXISTS HY000
1009 ER_DB_DROP_DELETE HY000
1010 ER_DB_DROP_RMDIR HY000
1011 ER_CANT_DELETE_FILE HY000
1012 ER_CANT_FIND_SYSTEM_REC HY000
1013 ER_CANT_GET_STAT HY000
1014 ER_CANT_GET_WD HY000
1015 ER_CANT_LOCK HY000
1016 ER_CANT_OPEN_FILE HY000
1017 ER_FILE_NOT_FOUND HY000
1018 ER_CANT_READ_DIR HY000
1019 ER_CANT_SET_WD HY000
1020 ER_CHECKREAD HY000
1021 ER_DISK_FULL HY000
1022 ER_DUP_KEY 23000
1023 ER_ERROR_ON_CLOSE HY000
1024 ER_ERROR_ON_READ HY000
1025 ER_ERROR_ON_RENAME HY000
1026 ER_ERROR_ON_WRITE HY000
1027 ER_FILE_USED HY000
1028 ER_FILSORT_ABORT HY000
1029 ER_FORM_NOT_FOUND HY000
1030 ER_GET_ERRNO HY000
1031 ER_ILLEGAL_HA HY000
1032 ER_KEY_NOT_FOUND HY000
1033 ER_NOT_FORM_FILE HY000
1034 ER_NOT_KEYFILE HY000
1035 ER_OLD_KEYFILE HY000
1036 ER_OPEN_AS_READONLY HY000
1037 ER_OUTOFMEMORY HY001
1038 ER_OUT_OF_SORTMEMORY HY001
1039 ER_UNEXPECTED_EOF HY000
1040 ER_CON_COUNT_ERROR 08004
1041 ER_OUT_OF_RESOURCES HY000
1042 ER_BAD_HOST_ERROR 08S01
1043 ER_HANDSHAKE_ERROR 08S01
1044 ER_DBACCESS_DENIED_ERROR 42000
1045 ER_ACCESS_DENIED_ERROR 28000
1046 ER_NO_DB_ERROR 3D000
1047 ER_UNKNOWN_COM_ERROR 08S01
1048 ER_BAD_NULL_ERROR 23000
1049 ER_BAD_DB_ERROR 42000
1050 ER_TABLE_EXISTS_ERROR 42S01
1051 ER_BAD_TABLE_ERROR 42S02
1052 ER_NON_UNIQ_ERROR 23000
1053 ER_SERVER_SHUTDOWN 08S01
1054 ER_BAD_FIELD_ERROR 42S22
1055 ER_WRONG_FIELD_WITH_GROUP 42000
1056 ER_WRONG_GROUP_FIELD 42000
1057 ER_WRONG_SUM_SELECT 42000
1058 ER_WRONG_VALUE_COUNT 21S01
1059 ER_TOO_LONG_IDENT 42000
1060 ER_DUP_FIELDNAME 42S21
1061 ER_DUP_KEYNAME 42000
1062 ER_DUP_ENTRY 23000
1063 ER_WRONG_FIELD_SPEC 42000
1064 ER_PARSE_ERROR 42000
1065 ER_EMPTY_QUERY 42000
1066 ER_NONUNIQ_TABLE 42000
1067 ER_INVALID_DEFAULT 42000
1068 ER_MULTIPLE_PRI_KEY 42000
1069 ER_TOO_MANY_KEYS 42000
1070 ER_TOO_MANY_KEY_PARTS 42000
1071 ER_TOO_LONG_KEY 42000
1072 ER_KEY_COLUMN_DOES_NOT_EXITS 42000
1073 ER_BLOB_USED_AS_KEY 42000
1074 ER_TOO_BIG_FIELDLENGTH 42000
1075 ER_WRONG_AUTO_KEY 42000
1076 ER_READY HY000
1077 ER_NORMAL_SHUTDOWN HY000
1078 ER_GOT_SIGNAL HY000
1079 ER_SHUTDOWN_COMPLETE HY000
1080 ER_FORCING_CLOSE 08S01
1081 ER_IPSOCK_ERROR 08S01
1082 ER_NO_SUCH_INDEX 42S12
1083 ER_WRONG_FIELD_TERMINATORS 42000
1084 ER_BLOBS_AND_NO_TERMINATED 42000
1085 ER_TEXTFILE_NOT_READABLE HY000
1086 ER_FILE_EXISTS_ERROR HY000
1087 ER_LOAD_INFO HY000
1088 ER_ALTER_INFO HY000
1089 ER_WRONG_SUB_KEY HY000
1090 ER_CANT_REMOVE_ALL_FIELDS 42000
1091 ER_CANT_DROP_FIELD_OR_KEY 42000
1092 ER_INSERT_INFO HY000
1093 ER_UPDATE_TABLE_USED HY000
1094 ER_NO_SUCH_THREAD HY000
1095 ER_KILL_DENIED_ERROR HY000
1096 ER_NO_TABLES_USED HY000
1097 ER_TOO_BIG_SET HY000
1098 ER_NO_UNIQUE_LOGFILE HY000
1099 ER_TABLE_NOT_LOCKED_FOR_WRITE HY000
1100 ER_TABLE_NOT_LOCKED HY000
1101 ER_BLOB_CANT_HAVE_DEFAULT 42000
1102 ER_WRONG_DB_NAME 42000
1103 ER_WRONG_TABLE_NAME 42000
1104 ER_TOO_BIG_SELECT 42000
1105 ER_UNKNOWN_ERROR HY000
1106 ER_UNKNOWN_PROCEDURE 42000
1107 ER_WRONG_PARAMCOUNT_TO_PROCEDURE 42000
1108 ER_WRONG_PARAMETERS_TO_PROCEDURE HY000
1109 ER_UNKNOWN_TABLE 42S02
1110 ER_FIELD_SPECIFIED_TWICE 42000
1111 ER_INVALID_GROUP_FUNC_USE HY000
1112 ER_UNSUPPORTED_EXTENSION 42000
1113 ER_TABLE_MUST_HAVE_COLUMNS 42000
1114 ER_RECORD_FILE_FULL HY000
1115 ER_UNKNOWN_CHARACTER_SET 42000
1116 ER_TOO_MANY_TABLES HY000
1117 ER_TOO_MANY_FIELDS HY000
1118 ER_TOO_BIG_ROWSIZE 42000
1119 ER_STACK_OVERRUN HY000
1120 ER_WRONG_OUTER_JOIN 42000
1121 ER_NULL_COLUMN_IN_INDEX 42000
1122 ER_CANT_FIND_UDF HY000
1123 ER_CANT_INITIALIZE_UDF HY000
1124 ER_UDF_NO_PATHS HY000
1125 ER_UDF_EXISTS HY000
1126 ER_CANT_OPEN_LIBRARY HY000
1127 ER_CANT_FIND_DL_ENTRY HY000
1128 ER_FUNCTION_NOT_DEFINED HY000
1129 ER_HOST_IS_BLOCKED HY000
1130 ER_HOST_NOT_PRIVILEGED HY000
1131 ER_PASSWORD_ANONYMOUS_USER 42000
1132 ER_PASSWORD_NOT_ALLOWED 42000
1133 ER_PASSWORD_NO_MATCH 42000
1134 ER_UPDATE_INFO HY000
1135 ER_CANT_CREATE_THREAD HY000
1136 ER_WRONG_VALUE_COUNT_ON_ROW 21S01
1137 ER_CANT_REOPEN_TABLE HY000
1138 ER_INVALID_USE_OF_NULL 22004
1139 ER_REGEXP_ERROR 42000
1140 ER_MIX_OF_GROUP_FUNC_AND_FIELDS 42000
1141 ER_NONEXISTING_GRANT 42000
1142 ER_TABLEACCESS_DENIED_ERROR 42000
1143 ER_COLUMNACCESS_DENIED_ERROR 42000
1144 ER_ILLEGAL_GRANT_FOR_TABLE 42000
1145 ER_GRANT_WRONG_HOST_OR_USER 42000
1146 ER_NO_SUCH_TABLE 42S02
1147 ER_NONEXISTING_TABLE_GRANT 42000
1148 ER_NOT_ALLOWED_COMMAND 42000
1149 ER_SYNTAX_ERROR 42000
1205 ER_LOCK_WAIT_TIMEOUT HY000
1213 ER_LOCK_DEADLOCK 40001
1216 ER_NO_REFERENCED_ROW 23000
1217 ER_ROW_IS_REFERENCED 23000
1236 ER_MASTER_FATAL_ERROR_READING_BINLOG HY000
1264 ER_WARN_DATA_OUT_OF_RANGE 22003
1365 ER_DIVISION_BY_ZERO 22012
1406 ER_DATA_TOO_LONG 22001
1451 ER_ROW_IS_REFERENCED_2 23000
1452 ER_NO_REFERENCED_ROW_2 23000
1690 ER_DATA_OUT_OF_RANGE 22003
"""


def error_rows() -> list[tuple[int, str, str]]:
    return [(int(code), name, state) for code, name, state in (r.split() for r in ERRORS.strip().split("\n"))]
