"""Small raw files with the defects the layers have to handle."""

RAW = {
    "PersonCountryRegion": """CountryRegionCode,Name,ModifiedDate
US,Usland,2008-04-30
CA ,Canland,2008-04-30
CA,Old Canland,2009-04-30 10:00:00
KR,"Korea, Republic of",2008-04-30
FR,"La ""France"" Ñ",2008-04-30
""",
    "PersonStateProvince": """StateProvinceID,StateProvinceCode,CountryRegionCode,IsOnlyStateProvinceFlag,Name,TerritoryID,rowguid,ModifiedDate
1,AB ,CA,False,Alberta,6,x,2013-03-04 05:06:07.089
2,WA ,US,False,Washington,1,x,2013-03-04 05:06:07.089
3,QC ,CA,False,Québec,6,x,2013-03-04 05:06:07.089
4,ZZ ,XX,True,Nowhere,99,x,2013-03-04 05:06:07.089
""",
    "ProductionProductCategory": """ProductCategoryID,Name,rowguid,ModifiedDate
1,Bikes,x,2008-04-30
2, Components ,x,2008-04-30
2.0,Old components,x,2007-04-30
""",
    "ProductionProductSubcategory": """ProductSubcategoryID,ProductCategoryID,Name,rowguid,ModifiedDate
1,1,Mountain Bikes,x,2008-04-30
2,2,Forks,x,2008-04-30
3,9,Orphans,x,2008-04-30
""",
    "ProductionProductCostHistory": """ProductID,StartDate,EndDate,StandardCost,ModifiedDate
707,2011-05-31,2012-05-29,11.25,2012-05-29
707,2012-05-30,2013-05-29,12.375,2013-05-29
707,2012-05-30,2013-05-29,99,2011-05-29
707,2013-05-30,,14.0625,2013-05-16
708,2012-01-01,2012-12-31,20.5,2013-05-16
709,2012-01-01,2012-12-31,5.5,2013-05-16
709,2012-06-01,2012-12-31,6.5,2013-05-16
""",
    "SalesCurrency": """CurrencyCode,Name,ModifiedDate
usd,US Dollar,2008-04-30
CAD,Canland Dollar,2008-04-30
 eur,Euro,2008-04-30
""",
    "SalesCurrencyRate": """CurrencyRateID,CurrencyRateDate,FromCurrencyCode,ToCurrencyCode,AverageRate,EndOfDayRate,ModifiedDate
1,2011-05-31,USD,CAD ,1.5500,1.5400,2011-05-31
2,2011-05-31,USD,XXX,10,11,2011-05-31
""",
    "SalesSalesTerritory": """TerritoryID;Name;CountryRegionCode;Group;SalesYTD;SalesLastYear;CostYTD;CostLastYear;rowguid;ModifiedDate
1;Northwest;US;North America;1200345.5;987654.25;0.0;0.0;x;2008-04-30
6;Canada;CA;North America;54321.0625;43210.5;0.0;0.0;x;2008-04-30
7;Atlantis;YY;;1;1;0.0;0.0;x;2008-04-30
""",
    "SalesSpecialOffer": """SpecialOfferID,Description,DiscountPct,Type,Category,StartDate,EndDate,MinQty,MaxQty,rowguid,ModifiedDate
1,No Discount,0.0,No Discount,No Discount,2011-05-01,2014-11-30,0,,x,2011-04-01
2,Volume Discount 12 to 15,0.02,Volume Discount,Reseller,2011-05-31,2014-05-30 00:00:00,12,15.0,x,2011-05-01
""",
    "PersonAddress": """AddressID,AddressLine1,AddressLine2,City,StateProvinceID,PostalCode,ModifiedDate
1," 1 Main St
Floor 2 ",,Calgary,1,T2P,2010-03-01
2,2 Pine, Apt 4,Seattle,2,98101,2010-03-01
3,3 Oak,,Seattle,2,98101,2010-03-01
4,4 Elm,,Montréal,3,H1Y,2010-03-01
5,5 Null,,Seattle,2,,2010-03-01
6,6 Far,,Nowhere,4,00000,2010-03-01
7,7 Lost,,Lost,77,11111,2010-03-01
""",
    "PersonBusinessEntityAddress": """BusinessEntityID,AddressID,AddressTypeID,ModifiedDate
1,1,2,2010-03-01
1,2,2,2010-03-01
1,4,3,2010-03-01
2,5,2,2010-03-01
3,6,2,2010-03-01
4,99,2,2010-03-01
6,7,2.0,2010-03-01
6,3,5,2010-03-01
""",
    "SalesvPersonDemographics": """BusinessEntityID,BirthDate,MaritalStatus,YearlyIncome,Gender,TotalChildren,NumberChildrenAtHome,Education,Occupation,HomeOwnerFlag,NumberCarsOwned
1,1970-01-15, m,25001-50000 ,f,2.0,,Bachelors ,skilled manual,1,0
0,1970-01-15,m,x,f,2,0,a,b,1,0
,1970-01-15,m,x,f,2,0,a,b,1,0
3,,,,,,,,,,
""",
    "PersonEmailAddress": """BusinessEntityID,EmailAddressID,EmailAddress,ModifiedDate
1,1,a@example.com,2012-01-01
1,2, b@example.com ,2012-01-01
-1,3,c@example.com,2012-01-01
3,4,,2012-01-01
""",
    "PersonPerson": """BusinessEntityID,PersonType,NameStyle,Title,FirstName,MiddleName,LastName,Suffix,EmailPromotion,ModifiedDate
1,IN,False,Mr.,Ann, ,Lee,,1,2014-06-01
1,EM,True,Dr.,Old,,Version,,0,2009-06-01
2,IN ,False,,Bob,B,Ñuñez,Jr.,2.0,2014-06-01
3,IN,,,,,,,,2014-06-01
4,IN,False,,Dan,,Ray,,0,2014-06-01
5,SC,False,,Store,,Contact,,0,2014-06-01
6,IN,False,,No,,Customer,,0,2014-06-01
""",
    "PersonPersonPhone": """BusinessEntityID,PhoneNumber,PhoneNumberTypeID,ModifiedDate
1,1 (11) 500 555-0132,1,2009-01-01
1,1(11) 500 555-0132,1,2010-01-01
1,11 500 555-0132,2,2008-01-01
2, 612-555-0100 ,1,2009-01-01
0,000,1,2009-01-01
""",
    "ProductionProduct": """ProductID,Name,ProductNumber,MakeFlag,FinishedGoodsFlag,Color,SafetyStockLevel,ReorderPoint,StandardCost,ListPrice,Size,SizeUnitMeasureCode,WeightUnitMeasureCode,Weight,DaysToManufacture,ProductLine,Class,Style,ProductSubcategoryID,SellStartDate,SellEndDate,DiscontinuedDate,ModifiedDate
707,Helmet,hl-u509,0,1,red,4,3,14.0625,35.5,M ,,,,0,S,,,1.0,2011-05-31,,,2013-03-04 06:07:08.091
708,Fork,fk-1,1,True,,500,375,20.5,40,48,CM,G,2.12,1,R,L,W,2,2011-05-31,2012-05-29,,2013-03-04 06:07:08.091
709,Odd,od-1,1,,,500,375,5.5,9.5,70,CM,G,10000000.0,1,,,,3,2011-05-31,,,2013-03-04 06:07:08.091
710,Loose,lo-1,1,0,,500,375,0,0,,,,0.0005,1,,,,,2011-05-31,,,2013-03-04 06:07:08.091
""",
    "ProductionvProductAndDescription": """ProductID,Name,ProductModel,CultureID,Description
707,Helmet,Sport-100,en ,Universal fit
707,Helmet,Sport-100,fr,Universel
708,Fork,Fork X,fr,Fourche
0,Nothing,None,en,None
""",
    "SalesCustomer": """CustomerID,PersonID,StoreID,TerritoryID,AccountNumber,ModifiedDate
11,1,,1,AW00000011,2013-10-11 12:13:14.156
12,2.0,,6.0,AW00000012 ,2013-10-11 12:13:14.156
13,,292,1,AW00000013,2013-10-11 12:13:14.156
14,4,,1,AW00000014,2013-10-11 12:13:14.156
15,4,,1,AW00000015,2013-10-11 12:13:14.156
""",
    "SalesSalesOrderDetail": """SalesOrderID,SalesOrderDetailID,CarrierTrackingNumber,OrderQty,ProductID,SpecialOfferID,UnitPrice,UnitPriceDiscount,LineTotal,ModifiedDate
100,1,4911-AB-7,1,707,1,10,0.0,10,2012-05-29
100,2, ,3,707,2,10.5,0.02,30.87,2012-05-29
100,2,old,9,707,2,1,0,9,2011-05-29
100,3,,1,708,1,7.7777,0.0,7.7777,2012-05-29
101,4,,2,710,9,3.3333,0.0,6.6666,2012-05-29
102,5,,1,707,1,5,0,5,2012-05-29
102,6,,1,707,1,-5,0,-5,2012-05-29
104,7,,1,709,1,4,0,4,2012-05-29
104,8,,1,708,1,6,0,6,2012-05-29
105,9,,1,707,1,4,0,4,2012-05-29
106,10,,1,707,1,4,0,4,2012-05-29
107,11,,1,707,1,4,0,4,2012-05-29
""",
    "SalesSalesOrderHeader": """SalesOrderID,RevisionNumber,OrderDate,DueDate,ShipDate,Status,OnlineOrderFlag,SalesOrderNumber,PurchaseOrderNumber,AccountNumber,CustomerID,SalesPersonID,TerritoryID,BillToAddressID,ShipToAddressID,ShipMethodID,CreditCardID,CreditCardApprovalCode,CurrencyRateID,SubTotal,TaxAmt,Freight,TotalDue,Comment,ModifiedDate
100,8,2012-05-29,2012-06-10,2012-06-05,5,1,SO100,PO1,10-1,11,,6,1,1,1,,,1,48.6477,3.8918,1.2162,53.7557,,2012-06-05
101,8,2012-05-30,2012-06-10,,5,True,SO101,,10-1,12,,1,1,1,1,,,2,6.6666,0.5333,0.1667,7.3666,,2012-06-05
102,8,2013-05-30,2013-06-10,2013-06-05,5,1,SO102,,10-1,13,,7,1,1,1,,,,10,1,0.5,11.5,,2012-06-05
103,8,2013-05-30,2013-06-10,2013-06-05,5,1,SO103,,10-1,99,,55,1,1,1,,,,12.3456,1,0.5,13.8,,2012-06-05
104,8,2012-06-01,2013-06-10,2013-06-05,5,1,SO104,,10-1,15,,1,1,1,1,,,,10,1,0.5,11.5,,2012-06-05
105,8,2012-06-01,2013-06-10,2013-06-05,5,0,SO105,,10-1,14,,1,1,1,1,,,,10,1,0.5,11.5,,2012-06-05
106,8,2010-06-01,2013-06-10,2013-06-05,5,1,SO106,,10-1,14,279.0,1,1,1,1,,,,4,1,0.5,5.5,,2012-06-05
,8,2012-06-02,2013-06-10,,5,1,SO108,,10-1,14,,1,1,1,1,,,,8,1,0.5,9.5,,2012-06-05
107,8,2012-06-01,2013-06-10,2013-06-05,5,,SO107,,10-1,14,279.0,1,1,1,1,,,,4,1,0.5,5.5,,2012-06-05
""",
}
