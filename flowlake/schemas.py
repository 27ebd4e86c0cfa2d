"""Explicit schemas of the nested inputs.  Jobs never infer a schema."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

REVISION = T.StructType([T.StructField("clientId", S), T.StructField("version", T.LongType())])
POSITION = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])

PROCESSOR = T.StructType([
    T.StructField("id", S),
    T.StructField("revision", REVISION),
    T.StructField("component", T.StructType([
        T.StructField("name", S), T.StructField("type", S), T.StructField("position", POSITION),
        T.StructField("config", T.StructType([
            T.StructField("properties", T.MapType(S, S)),
            T.StructField("autoTerminatedRelationships", T.ArrayType(S)),
        ])),
        T.StructField("validationErrors", T.ArrayType(S)),
    ])),
    T.StructField("status", T.StructType([
        T.StructField("runStatus", S), T.StructField("validationErrors", T.ArrayType(S)),
    ])),
])

ENDPOINT = T.StructType([T.StructField("id", S), T.StructField("groupId", S), T.StructField("type", S)])

CONNECTION = T.StructType([
    T.StructField("id", S),
    T.StructField("revision", REVISION),
    T.StructField("component", T.StructType([
        T.StructField("name", S), T.StructField("source", ENDPOINT), T.StructField("destination", ENDPOINT),
        T.StructField("selectedRelationships", T.ArrayType(S)),
        T.StructField("backPressureObjectThreshold", T.LongType()),
        T.StructField("backPressureDataSizeThreshold", S),
        T.StructField("flowFileExpiration", S),
    ])),
])

PORT = T.StructType([
    T.StructField("id", S),
    T.StructField("revision", REVISION),
    T.StructField("component", T.StructType([T.StructField("name", S), T.StructField("state", S)])),
])

CHILD_GROUP = T.StructType([
    T.StructField("id", S),
    T.StructField("component", T.StructType([T.StructField("name", S)])),
])

ID_ONLY = T.StructType([T.StructField("id", S)])

FLOW = T.StructType([
    T.StructField("processors", T.ArrayType(PROCESSOR)),
    T.StructField("connections", T.ArrayType(CONNECTION)),
    T.StructField("processGroups", T.ArrayType(CHILD_GROUP)),
    T.StructField("inputPorts", T.ArrayType(PORT)),
    T.StructField("outputPorts", T.ArrayType(PORT)),
    T.StructField("funnels", T.ArrayType(ID_ONLY)),
    T.StructField("labels", T.ArrayType(ID_ONLY)),
])

FLOW_DOCUMENT = T.StructType([
    T.StructField("id", S),
    T.StructField("processGroupFlow", T.StructType([
        T.StructField("id", S), T.StructField("uri", S), T.StructField("parentGroupId", S),
        T.StructField("parameterContext", T.StructType([T.StructField("id", S), T.StructField("name", S)])),
        T.StructField("breadcrumb", T.StructType([
            T.StructField("breadcrumb", T.StructType([T.StructField("name", S)]))])),
        T.StructField("flow", FLOW),
    ])),
    # null: the line is a whole document; else the line is one part of it (number 0: its first line)
    T.StructField("part", T.StructType([T.StructField("document", S), T.StructField("number", T.LongType())])),
    T.StructField("_corrupt_record", S),
])

# The seven member lists of a flow document, in the order the reference returns them.
FLOW_KINDS = ["processors", "connections", "processGroups", "inputPorts", "outputPorts", "funnels", "labels"]
