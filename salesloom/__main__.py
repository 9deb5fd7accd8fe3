from salesloom.plans.run import main

main()
