"""Fixed values of the tests: the small tables, and an access-log record in three encodings."""

SF_SMALL = "/root/testdata/sf0.001"

# An access-log record in the three encodings, its schema and rules.
ACCESS_FIELDS = {"ipAddress": "String", "method": "String", "endPoint": "String",
                 "protocol": "String", "responseCode": "Integer", "contentSize": "Integer"}
ACCESS_LINES = [f"{i}.1.1.1\tGET\t/apps/logs/LogAnalyzer.java\tHTTP/1.1\t200\t1000"
                for i in range(1, 8)]
ACCESS_JSON = ('{ "ipAddress":"1.1.1.1", "method":"GET", "endPoint":"/apps/logs/LogAnalyzer.java",'
               ' "protocol":"HTTP/1.1", "responseCode":"200", "contentSize":"1000"}')
ACCESS_XML = ('<xml> <entry key="ipAddress">1.1.1.1</entry> <entry key="method">GET</entry>'
              '<entry key="endPoint">/apps/logs/LogAnalyzer.java</entry> '
              '<entry key="protocol">HTTP/1.1</entry> <entry key="responseCode">200</entry> '
              '<entry key="contentSize">1000</entry></xml>')
ACCESS_RULES = ['contentSizeWithUnit:org.example.MyFunctions:add:$contentSize,"KB"',
                'size:org.example.MyFunctions:add:$contentSize,"MB"']
ACCESS_OUTPUT = {"contentSizeWithUnit": "String", "size": "String"}
