from tillroll.cli import main

main()
